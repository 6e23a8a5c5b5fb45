"""Small tables with every edge the operators must take, and plain models of what they do."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, n int, row long, size long, `range` int, `key` string"


def words(text):
    return WORD.findall(text or "")


def docs(spark, rows):
    """rows: (doc_id, text[, source]); further columns clash with names used inside the operators."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), 7, 7, 7, 7, 7, "k") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def corpus(n=60, seed=1):
    """Texts with copies, near copies, shared passages, nulls, blanks and one long text."""
    r = random.Random(seed)
    voc = ["w%d" % i for i in range(300)] + ["Ünï", "x,", "Y."]
    passage = [r.choice(voc) for _ in range(60)]
    out = []
    for i in range(n):
        ws = [r.choice(voc) for _ in range(r.randrange(1, 120))]
        kind = r.randrange(6)
        if kind == 0 and out:
            ws = words(r.choice(out)[1]) or ws
        elif kind == 1 and out:
            ws = words(r.choice(out)[1]) or ws
            ws = ws[:]
            ws[r.randrange(len(ws))] = "edit%d" % i
        elif kind == 2:
            at = r.randrange(len(ws))
            ws = ws[:at] + passage[: r.randrange(15, 60)] + ws[at:]
        sep = r.choice([" ", "\n", "\t "])
        out.append((i * 3 % 181, sep.join(ws), r.choice(["a", "b", None, "é"])))
    out += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "w1 " * 3000), (1004, "one two three"), (1005, "one  two\nthree "), (1006, "A b C d E f"), (1007, "a B c D e F")]
    return out

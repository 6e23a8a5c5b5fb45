"""Every signature with and without the gate, in plain, wrapped and commented text, and suppression by priority and containment."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lodeframe.llm import licenses
from lodeframe.llm.license_rules import RULES, SPDX_IDS
from lodeframe.llm.licenses import SPDX_PRIORITY, build_rules, by_keyword, detections, spdx_ids

BUILT = build_rules()
GATE = by_keyword(BUILT)
GAPS = (" ", "  ", "\n * ", "\t", "\r\n# ", "\n// ", "\n%  ")


def plain(expression):
    """The expression with single blanks and only letters where it allows anything, for samples."""
    return re.sub(r"\[\^\.\]", "[abc]", expression).replace(r"\d", "[0-9]")


def every(text):
    """All rules without a gate, and suppression in the plainest way."""
    found = [(-r.priority, m.start() - m.end(), m.start(), r.label) for r in BUILT for m in r.expression.finditer(text)] + spdx_ids(text)
    taken = []
    for less, width, start, label in sorted(found):
        end = start - width
        if not any(a <= start and end <= b or start <= a and b <= end for a, b, *_ in taken):
            taken.append((start, end, label, -less))
    return sorted(taken)


def test_rules_are_distinct_and_many():
    assert len(RULES) >= 250 and len({r[3] for r in RULES}) == len(RULES) and len({r[1] for r in RULES}) >= 80
    assert len(set(SPDX_IDS)) == len(SPDX_IDS)


@pytest.mark.parametrize("i", range(0, len(RULES), 8))
def test_gate_loses_nothing(i):
    """Strings made from each expression hold a keyword, match in every kind of gap, and are found alike with and without the gate."""
    for priority, label, keywords, expression in RULES[i : i + 8]:
        rule = next(r for r in BUILT if r.priority == priority and r.label == label and r.expression.pattern.decode().find(licenses.with_gaps(expression)) >= 0)

        @settings(max_examples=12, deadline=None, database=None, suppress_health_check=list(HealthCheck))
        @given(st.from_regex(plain(expression), fullmatch=True, alphabet=st.characters(min_codepoint=32, max_codepoint=126) if "©" not in expression else None), st.sampled_from(GAPS))
        def check(sample, gap):
            sample = sample.lower()
            assert any(k in sample for k in keywords.split("|")), (sample, keywords)
            text = ("x. " + sample + " .y").replace(" ", gap).encode()
            assert rule.expression.search(text), (text, rule.expression.pattern)
            assert detections(text, GATE) == every(text)

        check()


def test_mixed_texts():
    """Notices one after another and inside each other, with and without the gate."""
    r = random.Random(5)
    parts = [
        "licensed under the mit license", "gnu general public license, version 3", "permission is hereby granted, free of charge, to any person obtaining a copy of this software", "creative commons attribution 4.0", "all rights reserved",
        "mozilla public license, version 2.0", "gpl", "cc by-nc-sa 4.0", "spdx-license-identifier: (mit or apache-2.0) and gpl-2.0-or-later with classpath-exception-2.0", "apache license 2.0", "bsd", "new bsd license or later", "words of the text",
        "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation; either version 2 of the license, or (at your option) any later version",
    ]
    for _ in range(200):
        text = " ".join(r.choice(parts) for _ in range(r.randrange(1, 12))).replace(" ", r.choice(GAPS)).encode()
        assert detections(text, GATE) == every(text)


@pytest.mark.parametrize(
    "text, want",
    [
        ("licensed under the mit\nlicense", {"mit"}), ("gnu general\npublic license, version 3", {"gpl-3.0"}), ("permission is hereby\n * granted, free of charge, to any person obtaining a copy", {"mit"}), ("creative\ncommons attribution 4.0", {"cc-by"}),
        ("all rights\nreserved", {"reserved"}), ("mozilla\npublic license, version 2.0", {"mpl-2.0"}), ("the bsd license", {"bsd"}), ("apache license", {"apache"}), ("under the gpl", {"gpl"}), ("lgpl code", {"lgpl"}), ("mozilla public license", {"mpl"}),
        ("gnu general public license v2 or any later version", {"gpl-2.0-or-later"}), ("agpl-3.0-or-later", {"agpl-3.0-or-later"}), ("nothing here", set()), ("simplified bsd license and cc0 1.0", {"bsd-2-clause", "cc0-1.0"}),
        ("spdx-license-identifier: gpl-2.0-only with linux-syscall-note", {"gpl-2.0-only", "linux-syscall-note"}), ("cc by-nc-nd 4.0, not cc by", {"cc-by-nc-nd", "cc-by"}), ("https://www.apache.org/licenses/license-2.0", {"apache-2.0"}),
        ("acc byte, lgplx, mitigate the licenses", set()),
    ],
)
def test_labels(text, want):
    for gap in GAPS[:5] if "\n" not in text else (" ",):
        assert {x[2] for x in detections(text.replace(" ", gap if "spdx" not in text else " ").encode(), GATE)} == want


def test_priority_and_containment():
    text = b"it is licensed under the terms of the gnu lesser general public license version 2.1 or any later version"
    found = detections(text, GATE)
    # the long name holds shorter ones of lower priority, and nothing inside it is left
    assert [x[2] for x in found] == ["lgpl-2.1-or-later"] or {x[2] for x in found} >= {"lgpl-2.1-or-later"}
    assert all(not (a[0] <= b[0] and b[1] <= a[1]) for a in found for b in found if a != b)
    notice = "spdx-license-identifier: mit"
    assert [(x[2], x[3]) for x in detections(notice.encode(), GATE)] == [("mit", SPDX_PRIORITY)]


def test_long_gaps():
    assert [x[2] for x in detections(b"gpl" + b" " * 200_000 + b"3", GATE)] == ["gpl-3.0"]
    assert detections((b"general public * " * 20_000), GATE) == []

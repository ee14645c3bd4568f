import random
import re
import re._parser as regex_parser

from pyspark.sql import functions as F

from strata.llm import licenses
from strata.llm.license_rules import BASE, GROUPS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text):
    """The definition, without prefilter, byte tricks or a list of kept stretches."""
    words = WORD.findall(lower(text))
    base = [(i, label) for phrase, label in BASE.items() for p in [phrase.split()]
            for i in range(len(words)) if words[i:i + len(p)] == p]
    joined, found, number = " " + " ".join(words) + " ", [], 0
    for group, sure in GROUPS:
        for line in group.strip().splitlines():
            label, _, expression = [x.strip() for x in line.split("|", 2)]
            for m in re.finditer(" (?:" + expression + ")(?= )", joined):
                a = joined[:m.start() + 1].count(" ") - 1
                found.append((number, a, a + m[0].count(" "), label, sure))
            number += 1
    kept = []
    for d in found:  # in the order of the rules, then of the text
        if not any(k[1] <= d[1] and d[2] <= k[2] for k in kept):
            kept.append(d)
    miss = 1.0
    for label in {k[3] for k in kept}:
        miss *= 1 - max(k[4] for k in kept if k[3] == label)
    at = [i for i, _ in base]
    return (len(words), len(base), min(at, default=None), max(at, default=None),
            ",".join(sorted({x for _, x in base})), ",".join(sorted({x for _, x in base} | {k[3] for k in kept})),
            round(1 - miss, 9))


def digest(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))


def expand(tree, rng):
    out = ""
    for op, arg in tree:
        match str(op):
            case "LITERAL":
                out += chr(arg)
            case "IN":
                kind, value = rng.choice(arg)
                out += chr(value) if str(kind) == "LITERAL" else chr(rng.randint(*value))
            case "ANY":
                out += rng.choice("ab")
            case "MAX_REPEAT" | "MIN_REPEAT":
                out += "".join(expand(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 2))))
            case "SUBPATTERN":
                out += expand(arg[3], rng)
            case "BRANCH":
                out += expand(rng.choice(arg[1]), rng)
    return out


def test_rules_are_many_and_the_prefilter_loses_nothing():
    rules, _ = licenses._rules()
    assert len(rules) >= 300 and len({r.pattern.pattern for r in rules}) == len(rules)
    assert sorted(r.label for r in rules if r.base) == sorted(BASE.values())
    rng = random.Random(1)
    for r in rules:
        tree = regex_parser.parse(r.pattern.pattern.decode().removesuffix("(?= )"))
        for _ in range(60):
            words = expand(tree, rng).encode().split()
            assert r.needs <= set(words), (r.label, r.pattern.pattern)
            assert any(f[0] is r for f in licenses.detect(words)), (r.label, words)


def texts():
    rng = random.Random(2)
    rules, _ = licenses._rules()
    trees = [regex_parser.parse(r.pattern.pattern.decode().removesuffix("(?= )")) for r in rules]
    out = [None, "", " \n", "...", "GNU General\n public-license", "cc by cc by", "MIT License MIT license mit licenseé",
           "Apache License, Version 2.0; CC BY-NC 4.0", "gnu general public licenses", "İ Mit License", "mit\x1clicense",
           "mit license " * 30_000, "gnu " * 50_000 + "general public license"]
    for _ in range(150):
        parts = [rng.choice(["", "foo ", "mit ", "license ", "cc ", "by ", "3 ", "under the "])
                 + expand(rng.choice(trees), rng).strip() for _ in range(rng.randint(1, 6))]
        text = rng.choice([" ", ", ", "\n", " - "]).join(parts)
        out.append("".join(c.upper() if rng.random() < 0.3 else c for c in text))
    return out


def test_scan_equals_brute_force(spark):
    rows = [(i // 2 if i else None, t) for i, t in enumerate(texts())]  # ids repeat, one is null
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {c: F.lit(1) for c in ("labels", "score", "n_words", "_text", "words")})
    got = licenses.scan(docs).collect()
    short = [(i, t) for i, t in rows if len(t or "") < 5000]
    key = lambda x: str(x)
    assert sorted(((r.doc_id, digest(r)) for r in got if r.n_words < 5000), key=key) == sorted(
        ((i, brute(t)) for i, t in short), key=key)
    assert [r.n_base for r in got if r.n_words > 50_000] == [30_000, 1]
    assert all(d.first + d.words <= r.n_words for r in got for d in r.detections)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_priority_and_containment():
    def labels(text):
        return [(d.label, d.first, d.words) for d in licenses.suppress(licenses.detect(licenses.words_of(text)))]
    assert labels(b"the GNU General Public License, version 3") == [("gpl-3.0", 1, 6)]
    assert labels(b"CC BY-NC 4.0") == [("cc-by-nc-4.0", 0, 5)]
    assert labels(b"SPDX-License-Identifier: MIT and the MIT license") == [("mit", 0, 4), ("mit", 6, 2)]
    assert labels(b"mit licence") == []

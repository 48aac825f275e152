import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import prose, rows, stored_documents
from usagelens.llm import licenses
from usagelens.llm.decontaminate import words_of


def longest_common(a, b):
    table = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, table[j] = table[j], before + 1 if x == y else max(table[j], table[j - 1])
    return table[-1]


@pytest.mark.parametrize("seed", range(8))
def test_alignment_is_a_common_subsequence(seed):
    draw = random.Random(seed)
    template = words_of(licenses.TEMPLATES["MIT"])
    text = [w for w in template if draw.random() > 0.05]
    for _ in range(8):
        text.insert(draw.randint(0, len(text)), draw.choice(["foo", "the", "software"]))
    matched = licenses.align(text, template, 0, len(text))
    assert all(text[a] == template[b] for a, b in matched)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(matched, matched[1:], strict=False))
    assert len(matched) >= 0.97 * longest_common(text, template)


@pytest.mark.parametrize("seed", range(5))
def test_rising_is_longest(seed):
    draw = random.Random(seed)
    b = [draw.randint(0, 30) for _ in range(25)]
    got = licenses.rising(list(enumerate(b)))
    best = [1] * len(b)
    for i in range(len(b)):
        best[i] = 1 + max((best[j] for j in range(i) if b[j] < b[i]), default=0)
    assert len(got) == max(best) and all(x[1] < y[1] for x, y in zip(got, got[1:], strict=False))


def names(spark, tmp_path, texts):
    data = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    found = licenses.license_findings(stored_documents(spark, tmp_path, data)).collect()
    return {r["doc_id"]: r for r in found}


def test_texts_lines_edits_and_repeats(spark, tmp_path):
    mit, apache = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["Apache-2.0"]
    line = licenses.TEMPLATES["MIT line"]
    edited = mit.replace("copyright notice", "(C) statement").replace("Software", "Work", 2).upper()
    got = names(spark, tmp_path, [
        prose(1, 300), prose(2, 200) + " " + mit + " " + prose(3, 400), f"{mit}\n{mit} {apache}", edited, line + " " + prose(4, 50) + " " + line,
        "Released under the Mit license", "licensed", " ".join(mit.split()[:70]), prose(5, 3000) + " " + apache,
    ])
    assert got[0]["licenses"] == got[6]["licenses"] == got[7]["licenses"] == []
    assert got[1]["licenses"] == ["MIT"] and got[1]["coverage"] == [1.0]
    first = got[1]["first_word"][0]
    assert got[1]["last_word"][0] - first == len(words_of(mit)) and first == len(words_of(prose(2, 200)))
    assert got[2]["licenses"] == ["MIT", "MIT", "Apache-2.0"]
    assert got[3]["licenses"] == ["MIT"] and 0.9 < got[3]["coverage"][0] < 1
    assert got[4]["licenses"] == ["MIT line", "MIT line"] and got[5]["licenses"] == ["MIT line"]
    assert got[8]["licenses"] == ["Apache-2.0"]


def test_every_template_is_found_as_itself(spark, tmp_path):
    got = names(spark, tmp_path, [f"{prose(i, 40)} {text} {prose(i + 50, 40)}" for i, text in enumerate(licenses.TEMPLATES.values())])
    for i, name in enumerate(licenses.TEMPLATES):
        assert name in got[i]["licenses"], name


def spread_out(name, pieces, share, seed):
    """The template with insertions, in so many pieces, of a share of its length together."""
    body = words_of(licenses.TEMPLATES[name])
    extra = [w.encode() for w in prose(seed, int(len(body) * share)).split()]
    out = []
    for i in range(pieces + 1):
        out += body[len(body) * i // (pieces + 1) : len(body) * (i + 1) // (pieces + 1)]
        out += extra[len(extra) * i // pieces : len(extra) * (i + 1) // pieces] if i < pieces else []
    return b" ".join(out).decode()


@pytest.mark.parametrize("name", ["MIT", "ISC", "BSD", "Apache-2.0", "GPL", "MPL-2.0"])
def test_insertions_do_not_hide_a_license(spark, tmp_path, name):
    cases = [(pieces, share) for pieces in (1, 3, 9) for share in (0.1, 0.4, 0.6, 1.0, 2.0)]
    texts = [f"{prose(i, 900)} {spread_out(name, *case, 100 + i)} {prose(50 + i, 900)}" for i, case in enumerate(cases)]
    twice = " ".join([spread_out(name, 3, 1.0, 7), prose(8, 20), spread_out(name, 3, 1.0, 9)])
    got = names(spark, tmp_path, [*texts, twice])
    for i, case in enumerate(cases):
        assert got[i]["licenses"] == [name] and got[i]["coverage"][0] > 0.95, case
        size = len(words_of(spread_out(name, *case, 100 + i)))
        assert got[i]["last_word"][0] - got[i]["first_word"][0] >= 0.9 * size, case
    assert got[len(cases)]["licenses"] == [name, name]


def test_digest_of_odd_documents(spark, tmp_path):
    docs = stored_documents(spark, tmp_path).withColumn("licenses", F.lit(1)).withColumn("coverage", F.lit("c"))
    got = licenses.document_licenses(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, *_ in rows())
    assert {(r["n_found"], r["licenses"], r["coverage"], r["n_license_words"]) for r in got} == {(0, "", 0.0, 0)}
    assert licenses.document_licenses(stored_documents(spark, tmp_path, [], "none")).count() == 0

import random
import re
from collections import Counter

import pytest

from tests.llm.cases import prose, rows, stored_documents
from usagelens.llm import line_rules as L

SPACE = r"[^\x20\x09-\x0D]+"


def lower(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def holds(line, phrases):
    return any(re.search(f"(?<![a-z]){re.escape(p)}(?![a-z])", lower(line)) for p in phrases)


def reason(line):
    words = re.findall(SPACE, line)
    closed = re.search(r"[.!?:;…。！？][\"')\]”’»]*\Z", words[-1])
    marks = sum(w in L.SEPARATORS for w in words)
    if (marks >= 2 and marks * L.SEPARATOR_EVERY >= len(words)) or (len(words) <= L.MENU_WORDS and not closed and holds(line, L.MENU_PHRASES)):
        return "n_navigation"
    if len(words) < L.NOTICE_WORDS and holds(line, L.NOTICE_PHRASES):
        return "n_boilerplate"
    noisy = sum(bool(re.search(r"[#*$%&|<>]|[!?][!?]", w)) for w in words)
    if 100 * noisy > L.NOISE_PERCENT * len(words) or (len(words) < L.SENTENCE_WORDS and not closed):
        return "n_punctuation"
    return None


def brute(text):
    text = text or ""
    words = re.findall(SPACE, text)
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    reasons = [reason(x) for x in lines]
    out = dict.fromkeys(L.MEASURES, 0)
    out.update(
        n_words=len(words), word_chars=sum(map(len, words)), n_symbols=len(re.findall(r"[#*$%&|<>]", text)),
        n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(covered), n_lines=len(lines),
        lost_chars=sum(len("".join(re.findall(SPACE, x))) for x, r in zip(lines, reasons, strict=True) if r),
    )
    for r in reasons:
        if r:
            out[r] += 1
    base = out["n_words"] < 10 or 100 * out["n_repeat_words"] > 20 * out["n_words"]
    left = "\n".join(x for x in text.split("\n") if not re.search(SPACE, x) or not reason(x))
    return out, base, not base and 100 * out["lost_chars"] <= 30 * out["word_chars"], left


ODD = [
    "home | about | contact | jobs\n" + prose(1, 40) + ".\nAll Rights Reserved\nLog in",
    "login\ns " + prose(2, 30),
    prose(3, 12) + " login",
    "x" * 30 + "\n\n \n" + "x" * 30 + "\r\n" + "x" * 30 + "\r\nA B » C » D",
    "what?? is!! this## now%% here&& ok",
    "\n\nline one is here, with words that go on and on (end.)\n\n",
    "“quoted end.”\n« fin. »\nso 。\nno end",
    "privacy policy " + prose(4, 40),
    "a b c d e a b c d e a b c d e f g h i j k",
    "One very long line " * 3000 + "\nshort.\n" + "word " * 5 + "\n",
    "|\n|\n> | > x y z.\n" + "Tous droits réservés\n" + prose(6, 11) + ".",
]


def check(got, data):
    wanted = Counter()
    for doc, text, *_ in data:
        measures, base, kept, left = brute(text)
        wanted[(doc, *(measures[m] for m in L.MEASURES), base, kept, None if text is None else left.rstrip("\n"))] += 1
    assert wanted == Counter(
        (r["doc_id"], *(r[m] for m in L.MEASURES), r["base_failed"], r["kept"], None if r["clean_text"] is None else r["clean_text"].rstrip("\n")) for r in got
    )


def test_measures_verdicts_and_texts(spark, tmp_path):
    data = rows() + [(500 + i, t, "en", "s", 1) for i, t in enumerate(ODD)]
    docs = stored_documents(spark, tmp_path, data).selectExpr("*", "'x' AS kept", "'y' AS n_words", "1 AS _ul_body")
    check(L.cleaned(docs).collect(), data)
    digest = L.line_verdicts(docs)
    assert digest.count() == len(data) and digest.columns == ["doc_id", *L.MEASURES, "base_failed", "kept"]


@pytest.mark.parametrize("seed", range(3))
def test_random_lines(spark, tmp_path, seed):
    draw = random.Random(seed)
    parts = ["a", "b.", "c!!", "|", "»", "log in", "use cookies", "\n", "\n", " ", "é…", "#", "privacy", "policy", "\t", "x?", ")", "\r"]
    data = [(i, "".join(draw.choice(parts) + draw.choice(["", " "]) for _ in range(draw.randint(0, 60))), "en", "s", 0) for i in range(150)]
    check(L.cleaned(stored_documents(spark, tmp_path, data)).collect(), data)


def test_phrases_do_not_reach_into_the_next_document(spark, tmp_path):
    data = [(1, "please log", "en", "s", 0), (2, " in", "en", "s", 0), (3, "we have a login", "en", "s", 0), (4, "s follow", "en", "s", 0)]
    docs = stored_documents(spark, tmp_path, data).coalesce(1).orderBy("doc_id")
    assert {r["doc_id"]: r["n_navigation"] for r in L.line_verdicts(docs).collect()} == {1: 0, 2: 0, 3: 1, 4: 0}


def test_no_rows(spark, tmp_path):
    assert L.line_verdicts(stored_documents(spark, tmp_path, [])).count() == 0

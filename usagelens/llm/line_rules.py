"""Line-first cleaning: rules judge every line, failing lines go, documents that lose too much are rejected.

Lines are what lies between ``\\n``; a line without a word (a run of anything but ASCII white space) counts
nowhere. A line fails, in this order of reasons, when it is

* *navigation*: at least two of its words are separators (``SEPARATORS``) and at least one word in
  ``SEPARATOR_EVERY``, or it has at most ``MENU_WORDS`` words, one of ``MENU_PHRASES`` and no sentence mark
  at its end;
* *boilerplate*: fewer than ``NOTICE_WORDS`` words and one of ``NOTICE_PHRASES``;
* *punctuation*: more than ``NOISE_PERCENT`` of its words hold a symbol or a doubled ``!`` or ``?``, or it has
  fewer than ``SENTENCE_WORDS`` words and does not end in a sentence mark.

A document fails its base rules (too few words, too many words in repeated passages), or is rejected when
its failing lines hold more than ``LOST_PERCENT`` of the code points in its words. What is left of a kept
document is its other lines, in order.

One scan without a shuffle; every task works on a few megabytes of text at a time, on the bytes of many
documents at once. Null and empty texts have no words, fail the base rules and stay null and empty. Very
long texts are taken whole. Repeated lines, rows and ids are judged one by one. An empty table gives an
empty table. Extra columns are ignored.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ByteHasher, byte_class, mix, seeded, text_chunks, word_spans

MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20
LOST_PERCENT = 30

SEPARATORS = ("|", ">", "·", "»", "•", "›", "→")
SEPARATOR_EVERY = 5
MENU_WORDS = 6
NOTICE_WORDS = 30
NOISE_PERCENT = 30
SENTENCE_WORDS = 8

SYMBOLS = "#*$%&|<>"
MENU_PHRASES = (
    "home page", "main menu", "site map", "sitemap", "log in", "login", "sign in", "sign up", "register now", "my account",
    "next page", "previous page", "read more", "back to top", "skip to content", "contact us", "about us", "share this", "click here",
)
NOTICE_PHRASES = (
    "all rights reserved", "privacy policy", "cookie policy", "terms of use", "terms of service", "use cookies", "uses cookies",
    "accept cookies", "enable javascript", "lorem ipsum", "subscribe to our newsletter", "powered by", "alle rechte vorbehalten",
    "tous droits réservés", "todos los derechos reservados",
)

# marks that end a sentence, with what may close after them
_END = re.compile(rb"(?:[.!?:;]|\xe2\x80\xa6|\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f)(?:[\"')\]]|\xe2\x80\x9d|\xe2\x80\x99|\xc2\xbb)*\Z")


def _phrases(phrases) -> re.Pattern:
    return re.compile(b"(?<![a-z])(?:" + b"|".join(re.escape(p.encode()) for p in phrases) + b")(?![a-z])")


_MENU, _NOTICE = _phrases(MENU_PHRASES), _phrases(NOTICE_PHRASES)
_SYMBOL, _LOUD = byte_class(SYMBOLS.encode()), byte_class(b"!?")

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_navigation", "n_boilerplate", "n_punctuation", "lost_chars",
)


def _running(flags: np.ndarray) -> np.ndarray:
    """Counts before every place, one more than there are places."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums


def _repeated(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Flags of the entries whose (row, value) occurs at least twice."""
    order = np.lexsort((values, rows))
    same = (rows[order][1:] == rows[order][:-1]) & (values[order][1:] == values[order][:-1])
    out = np.zeros(len(rows), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


class LineJudge:
    """Measures of many documents that lie one after another in a byte buffer."""

    def __init__(self):
        self.hasher = ByteHasher(5)
        self.factors = seeded(REPEAT_WINDOW, 17)
        marks = [s.encode() for s in SEPARATORS]
        buf = np.frombuffer(b"".join(marks), np.uint8)
        ends = np.cumsum([len(m) for m in marks])
        self.hasher.load(buf)
        self.separators = self.hasher.between(ends - [len(m) for m in marks], ends)
        self.longest = max(len(m) for m in marks)

    def judge(self, buf: np.ndarray, offsets: np.ndarray):
        """(measures by name, one array per document; start, end and failed flag of every line with a word; its row)."""
        n = len(offsets) - 1
        start, end, row = word_spans(buf, offsets)
        self.hasher.load(buf)
        word = self.hasher.between(start, end)
        letters = _running((buf & 0xC0) != 0x80)  # code points
        points = letters[end] - letters[start]
        symbols = _running(_SYMBOL[buf])
        loud = _LOUD[buf]
        doubled = _running(np.append(loud[1:] & loud[:-1], False) if len(buf) else loud)
        noisy = (symbols[end] > symbols[start]) | (doubled[end - 1] > doubled[start])
        separator = np.zeros(len(word), bool)
        short = np.flatnonzero(end - start <= self.longest)
        separator[short] = np.isin(word[short], self.separators)

        breaks = np.flatnonzero(buf == 10)
        begins = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
        line_of = np.searchsorted(begins, start, "right") - 1
        first = np.flatnonzero(np.append(True, line_of[1:] != line_of[:-1])) if len(line_of) else line_of
        line_row, line_start = row[first], begins[line_of[first]]
        stop = np.append(breaks, len(buf))[np.searchsorted(breaks, line_start)] if len(first) else first
        line_end = np.minimum(stop, offsets[line_row + 1])
        ends = np.append(first[1:], len(start)) if len(first) else first
        words = ends - first
        last_word, text_end = start[ends - 1], end[ends - 1]

        def per_line(flags):
            sums = _running(flags)
            return sums[ends] - sums[first]

        data = buf.tobytes()
        closed = np.ones(len(first), bool)
        for i in np.flatnonzero(words < max(SENTENCE_WORDS, MENU_WORDS + 1)):
            closed[i] = _END.search(data, int(last_word[i]), int(text_end[i])) is not None
        # a break behind every document keeps phrases from meeting the next one; it shifts row r by r bytes
        lowered = np.insert(buf, offsets[1:], 10).tobytes().lower()
        shifted_start, shifted_end = line_start + line_row, line_end + line_row

        def holds(pattern):
            found = np.zeros(len(first), bool)
            at = np.array([m.span() for m in pattern.finditer(lowered)], np.int64).reshape(-1, 2)
            line = np.searchsorted(shifted_start, at[:, 0], "right") - 1
            found[line[(line >= 0) & (at[:, 1] <= shifted_end[line])]] = True
            return found

        marks = per_line(separator)
        navigation = (marks >= 2) & (marks * SEPARATOR_EVERY >= words)
        navigation |= (words <= MENU_WORDS) & ~closed & holds(_MENU)
        boilerplate = ~navigation & (words < NOTICE_WORDS) & holds(_NOTICE)
        noise = 100 * per_line(noisy) > NOISE_PERCENT * words
        punctuation = ~navigation & ~boilerplate & (noise | ((words < SENTENCE_WORDS) & ~closed))
        failed = navigation | boilerplate | punctuation
        line_points = per_line(points)

        whole = np.flatnonzero(row[REPEAT_WINDOW - 1 :] == row[: max(0, len(row) - REPEAT_WINDOW + 1)])
        windows = np.zeros(len(whole), np.uint64)
        for i, factor in enumerate(self.factors):
            windows += mix(word[whole + i] + factor) * (factor | np.uint64(1))
        again = whole[_repeated(row[whole], windows)]
        cover = np.zeros(len(word) + 1, np.int64)
        np.add.at(cover, again, 1)
        np.add.at(cover, again + REPEAT_WINDOW, -1)
        covered = np.cumsum(cover[:-1]) > 0

        content = self.hasher.between(line_start, line_end)
        order = np.lexsort((content, line_row))
        same = (line_row[order][1:] == line_row[order][:-1]) & (content[order][1:] == content[order][:-1])

        def by_row(rows, weights=None):
            return np.bincount(rows, weights=weights, minlength=n).astype(np.int64)

        measures = {
            "n_words": by_row(row),
            "word_chars": by_row(row, points),
            "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
            "n_dup_lines": by_row(line_row[order][1:][same]),
            "n_repeat_words": by_row(row[covered]),
            "n_lines": by_row(line_row),
            "n_navigation": by_row(line_row[navigation]),
            "n_boilerplate": by_row(line_row[boilerplate]),
            "n_punctuation": by_row(line_row[punctuation]),
            "lost_chars": by_row(line_row[failed], line_points[failed]),
        }
        return measures, line_start, line_end, line_row, failed


def _judged(names: list[str], with_text: bool):
    def run(batches):
        judge = LineJudge()
        for batch in batches:
            for first, last, buf, offsets in text_chunks(batch.column("_ul_body")):
                measures, start, end, row, failed = judge.judge(buf, offsets)
                cut = batch.slice(first, last - first)
                columns = [cut.column(name) for name in names] + [pa.array(measures[name]) for name in MEASURES]
                if with_text:
                    columns.append(_remaining(buf, offsets, start, end, row, failed, cut.column("_ul_body").is_null()))
                yield pa.RecordBatch.from_arrays(columns, [*names, *MEASURES, *(["clean_text"] if with_text else [])])

    return run


def _remaining(buf, offsets, start, end, row, failed, missing) -> pa.Array:
    """The documents without their failing lines and the line breaks behind those."""
    cut = np.zeros(len(buf) + 1, np.int64)
    past = np.minimum(end + 1, offsets[row + 1])
    np.add.at(cut, start[failed], 1)
    np.add.at(cut, past[failed], -1)
    keep = np.cumsum(cut[:-1]) == 0
    ends = _running(keep)[offsets]
    return pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(buf[keep])]
    ).cast(pa.string()) if not missing.true_count else pa.array(
        [None if none else buf[a:b][keep[a:b]].tobytes().decode() for a, b, none in zip(offsets[:-1], offsets[1:], missing.to_pylist(), strict=True)],
        pa.string(),
    )


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Per document: id, the measures, base_failed, kept and, with ``with_text``, clean_text (lines that pass)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_ul_body"))
    schema = ", ".join([f"doc_id {dict(rows.dtypes)['doc_id']}", *(f"{name} bigint" for name in MEASURES)])
    out = rows.mapInArrow(_judged(["doc_id"], with_text), schema + (", clean_text string" if with_text else ""))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    lost = 100 * F.col("lost_chars") > LOST_PERCENT * F.col("word_chars")
    return out.withColumn("base_failed", base).withColumn("kept", ~base & ~lost)


def line_verdicts(docs: DataFrame) -> DataFrame:
    """Digest of all documents: doc_id, the measures, base_failed, kept."""
    return cleaned(docs, with_text=False)


def _alternatives(phrases) -> str:
    return "(^|[^a-z])(" + "|".join(re.escape(p).replace("\\ ", " ") for p in phrases) + ")($|[^a-z])"


# independent SQL: word lists and regular expressions line by line
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (SELECT r, line, regexp_extract_all(line, '{word}') AS w, translate(line, '{upper}', '{lower}') AS low FROM l),
m AS (
    SELECT r, line, low, len(w) AS n, list_sum(list_transform(w, lambda x: length(x))) AS points,
           len(list_filter(w, lambda x: list_contains([{separators}], x))) AS marks,
           len(list_filter(w, lambda x: regexp_matches(x, '[{symbols}]|[!?][!?]'))) AS noisy,
           regexp_matches(w[len(w)], '{ending}') AS closed
    FROM lw WHERE len(w) > 0
), f AS (
    SELECT *, (marks >= 2 AND marks * {every} >= n) OR (n <= {menu_words} AND NOT closed AND regexp_matches(low, '{menu}')) AS nav,
           n < {notice_words} AND regexp_matches(low, '{notice}') AS notice,
           100 * noisy > {noise} * n OR (n < {sentence} AND NOT closed) AS punct
    FROM m
), s AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (nav) AS n_navigation,
           count(*) FILTER (NOT nav AND notice) AS n_boilerplate, count(*) FILTER (NOT nav AND NOT notice AND punct) AS n_punctuation,
           coalesce(sum(points) FILTER (nav OR notice OR punct), 0) AS lost_chars
    FROM f GROUP BY r
), dw AS (
    SELECT r, doc_id, regexp_extract_all(t, '{word}') AS w, length(regexp_replace(t, '[^{symbols}]', '', 'g')) AS n_symbols FROM d
), g AS (
    SELECT r, i, array_to_string(w[i : i + {last}], ' ') AS g FROM (SELECT r, w, unnest(generate_series(1, len(w) - {last})) AS i FROM dw)
), again AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
c AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(generate_series(i, i + {last})) AS p FROM again) GROUP BY r),
v AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
           CAST(n_symbols AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
           CAST(coalesce(n_navigation, 0) AS BIGINT) AS n_navigation, CAST(coalesce(n_boilerplate, 0) AS BIGINT) AS n_boilerplate,
           CAST(coalesce(n_punctuation, 0) AS BIGINT) AS n_punctuation, CAST(coalesce(lost_chars, 0) AS BIGINT) AS lost_chars
    FROM dw LEFT JOIN s USING (r) LEFT JOIN c USING (r)
)
SELECT *, n_words < {min_words} OR 100 * n_repeat_words > {repeat} * n_words AS base_failed,
       NOT (n_words < {min_words} OR 100 * n_repeat_words > {repeat} * n_words) AND NOT (100 * lost_chars > {lost} * word_chars) AS kept
FROM v
""".format(
    word=r"[^\x20\x09-\x0D]+",
    upper="ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    lower="abcdefghijklmnopqrstuvwxyz",
    separators=", ".join(f"'{s}'" for s in SEPARATORS),
    symbols=SYMBOLS,
    ending=r"[.!?:;…。！？][\"'')\]”’»]*$",
    menu=_alternatives(MENU_PHRASES),
    notice=_alternatives(NOTICE_PHRASES),
    every=SEPARATOR_EVERY,
    menu_words=MENU_WORDS,
    notice_words=NOTICE_WORDS,
    noise=NOISE_PERCENT,
    sentence=SENTENCE_WORDS,
    last=REPEAT_WINDOW - 1,
    min_words=MIN_WORDS,
    repeat=REPEAT_PERCENT,
    lost=LOST_PERCENT,
)

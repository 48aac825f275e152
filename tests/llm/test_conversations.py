import hashlib
import random
import zlib
from itertools import product

import pytest

from usagelens.llm import conversations as C

TURNS = "conv_id bigint, turn bigint, role string, text string"
LEGAL = {"su", "ua", "au"}


def grammar(codes: str):
    """Cheapest (cost, audit) turn by turn through the automaton: another algorithm than the module's."""
    step = {"E": {"s": "S", "u": "A"}, "S": {"u": "A"}, "A": {"a": "U"}, "U": {"u": "A"}}
    ins = {"E": [("", "E"), ("I", "A"), ("II", "U")], "S": [("", "S"), ("I", "A"), ("II", "U")], "A": [("", "A"), ("I", "U")], "U": [("", "U"), ("I", "A")]}
    best = {"E": (0, "")}
    for code in codes:
        ahead = {}
        for state, (cost, audit) in best.items():
            for pre, via in ins[state]:
                ways = [("D", via, 2)]
                for symbol, there in step[via].items():
                    own = code.lower()
                    if code != "x" and (own == symbol or symbol != "s"):
                        ways.append(("K" if own == symbol else "R", there, (own != symbol) + 5 * code.isupper()))
                for edit, there, more in ways:
                    way = (cost + 5 * len(pre) + more, audit + pre + edit)
                    ahead[there] = min(ahead.get(there, way), way)
        best = ahead
    return min((cost + 5 * len(pre), audit + pre) for state, (cost, audit) in best.items() for pre, via in ins[state] if via in "EU")


def exhaustive(codes: str, most_in: int = 3):
    """All audits of a few turns, by trying every edit and every number of insertions."""
    found = []

    def go(i, audit, out, cost):
        if i == len(codes) and (out == "" or (out.removeprefix("s") and out.removeprefix("s") == "ua" * (len(out.removeprefix("s")) // 2))):
            found.append((cost, audit))
        if audit.count("I") < most_in:
            for symbol in "ua":
                go(i, audit + "I", out + symbol, cost + 5)
        if i < len(codes):
            go(i + 1, audit + "D", out, cost + 2)
            code = codes[i]
            if code != "x":
                extra = 5 * code.isupper()
                go(i + 1, audit + "K", out + code.lower(), cost + extra)
                for symbol in "ua":
                    go(i + 1, audit + "R", out + symbol, cost + extra + 1)

    go(0, "", "", 0)
    return min(found)


def test_every_short_conversation():
    for n in range(4):
        for codes in product("uasoUASx", repeat=n):
            codes = "".join(codes)
            assert C.align(codes) == grammar(codes), codes
    for codes in ["", "s", "S", "uu", "as", "xU", "oSa", "aau", "sxu", "UUa"]:
        assert C.align(codes) == exhaustive(codes), codes


@pytest.mark.parametrize("seed", range(4))
def test_long_conversations_in_blocks(seed):
    draw = random.Random(seed)
    for _ in range(150):
        n, noise = draw.randint(4, 90), draw.random()
        codes = "".join(draw.choice("uasoUASOx") if draw.random() < noise else "ua"[i % 2] for i in range(n))
        want = grammar(codes)
        for block in (1, 2, 7, 256):
            assert C.align(codes, block) == want, (codes, block)


def test_time_is_linear_in_the_turns():
    draw = random.Random(9)
    codes = "".join(draw.choice("uuuaaaUAxs") for _ in range(20_000))
    assert C.align(codes) == grammar(codes)


def brute(data):
    convs = {}
    for conv, turn, role, text in data:
        held = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        damage = zlib.crc32(key.encode()) % 20
        if damage == 0:
            continue
        if damage == 1:
            text = ""
        if damage == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if damage == 4:
            role = "user"
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        held += [(turn is not None, turn or 0, role, digest, turn, text)] * (2 if damage == 3 else 1)
    out = set()
    for conv, held in convs.items():
        held.sort(key=lambda r: (*r[:2], r[2].encode(), r[3]))
        counts, codes, seen, illegal, before = {"blank": 0, "duplicate": 0, "truncated": 0}, "", set(), 0, None
        for _, _, role, _, _, text in held:
            bare = text.rstrip(" \t\n\x0b\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = role[:1]
            illegal += before is not None and before + initial not in LEGAL
            before = initial
            code = initial if initial in ("u", "a", "s") else "o"
            codes += "x" if fault in ("blank", "duplicate") else code.upper() if fault else code
        cost, audit = grammar(codes)
        numbers = {r[4] for r in held} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        written, at, due = [], 0, "user"
        for edit in audit:
            if edit == "I":
                role, text = due, ""
            else:
                _, _, role, _, _, text = held[at]
                at += 1
                if edit == "D":
                    continue
                role = role if edit == "K" else due
            written.append(f"{role}:{text}")
            due = "assistant" if role[:1] == "u" else "user"
        out.add((conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(written).encode()).hexdigest()))
    return out


def cases():
    draw = random.Random(4)
    texts = ["Hello.", "Fine!", "And you?", "no end", "", " \t", None, "Hello.", "ünïcode …", "a " * 4000 + ".", "line\nbreak.", "dots...  \n"]
    data = []
    for conv in range(120):
        for turn in range(draw.choice([1, 2, 3, 8, 30])):
            role = draw.choice(["user", "assistant", "system", "tool", "", None, "User"]) if draw.random() < 0.2 else ("user", "assistant")[turn % 2]
            text = draw.choice(texts) if draw.random() < 0.4 else f"text {conv} {turn}."
            data.append((conv, draw.choice([turn, turn, turn, turn + 5, None]), role, text))
    data += [(None, t, "user", f"x{t}.") for t in range(6)] + [(500, None, None, None), (501, 3, "user", "again."), (501, 3, "user", "again."), (501, 3, "user", "other.")]
    return data


def test_whole_conversations(spark, tmp_path):
    data = cases()
    path = str(tmp_path / "turns")
    spark.createDataFrame(data, TURNS).repartition(5).selectExpr("*", "1 AS copy", "'x' AS audit", "2 AS place", "3 AS damage", "'d' AS digest").write.parquet(path)
    turns = spark.read.parquet(path)
    got = C.conversation_repairs(turns).collect()
    assert len(got) == len({c for c, *_ in data}) and set(map(tuple, got)) == brute(data)
    written = {}
    for r in C.repaired_turns(C.damaged(turns)).orderBy("conv_id", "place").collect():
        written.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in got:
        assert hashlib.sha256("\n".join(written.get(r["conv_id"], [])).encode()).hexdigest() == r["repaired_sha256"]


def test_one_conversation_with_a_third_of_all_turns(spark):
    data = [(7, t, ("user", "assistant")[t % 2], f"t{t % 900}.") for t in range(3000)] + [(100 + i // 4, i % 4, ("user", "assistant")[i % 2], f"y{i}.") for i in range(6000)]
    got = C.conversation_repairs(spark.createDataFrame(data, TURNS).repartition(6)).collect()
    assert set(map(tuple, got)) == brute(data)


def test_no_rows(spark):
    assert C.conversation_repairs(spark.createDataFrame([], TURNS)).count() == 0


def test_all_turns_lost(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = C.conversation_repairs(spark.createDataFrame([(lost, 0, "user", "x.")], TURNS)).collect()
    assert [tuple(r) for r in row] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]

"""Conversation repair against a plain recursion over suffixes, and the damage against a plain loop."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from textloom.llm import conversation_repair as repair
from textloom.llm import queries

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def least(codes):
    """(cost, audit) by recursion: of every place and state the smallest pair."""
    n = len(codes)
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * n + 1000))

    @lru_cache(maxsize=None)
    def best(i, state, inserts):
        found = [(0, "")] if i == n and state in ("", "a") else []
        if inserts:
            for turn in "ua":
                if (state, turn) in NEXT:
                    cost, rest = best(i, NEXT[state, turn], inserts - 1)
                    found.append((cost + 5, "I" + rest))
        if i < n:
            fault, initial = codes[i] & 3, "sua?"[codes[i] >> 2]
            cost, rest = best(i + 1, state, 3)
            found.append((cost + 2, "D" + rest))
            late = 5 if fault == repair.TRUNCATED else 0
            if fault in (repair.SOUND, repair.TRUNCATED):
                for letter, price, turns in (("K", 0, initial), ("R", 1, "ua")):
                    for turn in turns:
                        if (state, turn) in NEXT:
                            cost, rest = best(i + 1, NEXT[state, turn], 3)
                            found.append((cost + price + late, letter + rest))
        return min(found, default=(10**9, ""))

    return best(0, "", 3)


@pytest.mark.parametrize("seed", range(4))
def test_least_repair(seed):
    rng = random.Random(seed)
    for _ in range(400):
        codes = bytes(rng.choice([0, 4, 4, 4, 8, 8, 8, 12, 5, 6, 7, 11, 3, 15, 10]) for _ in range(rng.randrange(0, 12)))
        assert repair.least_repair(codes) == least(codes), codes
    for n in (repair.BLOCK, repair.BLOCK + 1, 3 * repair.BLOCK, 100):
        codes = bytes(rng.choice([4, 4, 8, 8, 12, 5, 7, 11, 3]) for _ in range(n))
        assert repair.least_repair(codes) == least(codes), codes


def test_layers_are_of_exact_costs():
    layers = repair.cost_layers(bytes([4, 8]), (0, 10, 5, 0))
    assert layers[0][0] == 0b1011 and layers[0][2] == 0b1001  # u a can be kept after nothing, s or a


def plain(rows):
    """Results of the whole table, rows being (conv_id, turn, role, text)."""
    convs = {r[0]: [] for r in rows}
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        role = "user" if harm == 4 else role
        convs[conv_id] += [(turn, role, text)] * (2 if harm == 3 else 1)
    out = {}
    for conv_id, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
        seen, codes = set(), []
        for _, role, text in turns:
            tail = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = 1 if not tail else 2 if (role, text) in seen else 3 if tail[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append({"s": 0, "u": 4, "a": 8}.get(role[:1], 12) + fault)
        cost, audit = least(bytes(codes))
        done, state, left = [], "", iter(turns)
        for letter in audit:
            _, role, text = (None, None, "") if letter == "I" else next(left)
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            done.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(d[0] for d in done))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = ["sua?"[c >> 2] for c in codes]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        faults = [sum(c & 3 == f for c in codes) for f in (1, 2, 3)]
        out[conv_id] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def result(df):
    rows = df.collect()
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("scale", ["", "sf0.01"])
def test_query(spark, sf_dir, scale):
    path = f"{sf_dir}/../{scale}" if scale else sf_dir
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{path}/conversations.parquet").collect()]
    assert result(queries.op12_conversation_repair(spark, path)) == plain(rows)


def odd_rows():
    rng = random.Random(9)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "Assistant"]
    texts = ["Yes.", "No!", "Why?", "open", " \t\n", "", None, "Ça va.  \n", "a. b", "Hm...", "x" * 300_000 + "."]
    rows = [(rng.randrange(12), rng.choice([*range(9), None]), rng.choice(roles), rng.choice(texts)) for _ in range(150)]
    rows += [(None, 1, "user", "Hello."), (None, 1, "user", "Hello."), (None, 2, "assistant", "Hi."), (77, None, None, None)]
    rows += [(500, t, "user" if t % 2 else "assistant", f"Turn {t % 37}.") for t in range(700)]
    return rows


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "c") for r in rows], "conv_id long, turn long, role string, text string, kind string, place int, audit string")


@pytest.mark.parametrize("held", [5_000, 3])
def test_odd_conversations(spark, held, monkeypatch):
    monkeypatch.setattr(repair, "HELD_ROWS", held)
    rows = odd_rows()
    frame = queries.damaged(conversations(spark, rows).repartition(5))
    assert result(repair.repair_summaries(frame, gone=F.col("gone"))) == plain(rows)


def test_repaired_turns(spark):
    rows = odd_rows()
    frame = queries.damaged(conversations(spark, rows))
    turns = sorted(repair.repaired_turns(frame, gone=F.col("gone")).collect(), key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["position"]))
    texts = {}
    for r in turns:
        texts.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    want = plain(rows)
    got = {c: hashlib.sha256("\n".join(texts.get(c, [])).encode()).hexdigest() for c in want}
    assert got == {c: v[-1] for c, v in want.items()}


def test_no_conversations(spark):
    assert repair.repair_summaries(queries.damaged(conversations(spark, [])), gone=F.col("gone")).count() == 0


def test_undamaged_conversation(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hi!")]
    (r,) = repair.repair_summaries(conversations(spark, rows)).collect()
    assert (r["cost"], r["audit"], r["illegal"], r["gaps"]) == (0, "KKK", 0, 0)

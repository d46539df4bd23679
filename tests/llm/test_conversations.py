"""Conversation repair against brute force."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tidemark.llm import conversations
from tidemark.llm.conversations import conversation_key, damaged, digests, repair_conversations
from tidemark.llm.queries import op12_conversations

SCHEMA = "conv_id long, turn long, role string, text string, conv string, position int, fault string"
EMPTY = hashlib.sha256(b"").hexdigest()


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def brute_repair(rows):
    """Suffix by suffix: the cheapest edits, then the least letters, of all edits with up to three insertions at a place."""
    faults, seen = [], set()
    for role, text in rows:
        letters = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)

    def goes(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    @lru_cache(maxsize=None)
    def best(at, state, inserted):
        found = []
        if inserted < 3:
            for role in ("user", "assistant"):
                then = goes(state, role[0])
                if then:
                    cost, audit, lines = best(at, then, inserted + 1)
                    found.append((cost + 2, "I" + audit, ((role, ""), *lines)))
        if at == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
            return min(found) if found else (10**9, "", ())
        (role, text), fault = rows[at], faults[at]
        cost, audit, lines = best(at + 1, state, 0)
        found.append((cost + 3, "D" + audit, lines))
        if fault not in ("blank", "duplicate"):
            for letter, new, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                then = goes(state, new[:1])
                if then:
                    cost, audit, lines = best(at + 1, then, 0)
                    found.append((cost + price + (fault == "truncated"), letter + audit, ((new, text), *lines)))
        return min(found)

    cost, audit, lines = best(0, "", 0)
    joined = "\n".join(f"{r}:{t}" for r, t in lines)
    return [faults.count(f) for f in ("blank", "duplicate", "truncated")], cost, audit, hashlib.sha256(joined.encode()).hexdigest()


def brute(original, rows):
    out = []
    for conv in {r[0] for r in original}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        if not own:
            out.append((conv, 0, 0, 0, 0, 0, 0, "", EMPTY))
            continue
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        faults, cost, audit, sha = brute_repair([r[2:4] for r in own])
        out.append((conv, gaps, *faults, illegal, cost, audit, sha))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def repaired(rows):
    report, lines = repair_conversations(rows)
    found = report.join(digests(lines), "conv", "left").join(rows.select("conv_id").distinct().withColumn("conv", conversation_key("conv_id")), "conv")
    return sorted((tuple(r) for r in found.selectExpr("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", f"coalesce(sha, '{EMPTY}')").collect()), key=str)


def random_rows(seed, convs, most):
    draw = random.Random(seed)
    out = []
    for conv in range(convs):
        for turn in range(draw.randint(1, most)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            text = draw.choice(["Fine.", "Cut off", "", " \n\x0b", "Why? ", f"Turn {turn}!", "é\x85", "Odd.\x85"])
            out.append((conv if draw.random() < 0.95 else None, draw.choice([turn, turn, turn + 1, None]), role, text))
    return out


@pytest.mark.parametrize("chunk", [1 << 14, 1, 3])
def test_random_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversations, "CHUNK_ROWS", chunk)
    rows = random_rows(chunk, 60, 7)
    assert repaired(frame(spark, rows)) == brute(rows, rows)


def test_long_conversations_in_chunks(spark, monkeypatch):
    """Chunks that never converge from one vector alone: only system rows, only rows to delete, and no fault at all."""
    monkeypatch.setattr(conversations, "CHUNK_ROWS", 16)
    rows = [(1, k, "system", f"Line {k}.") for k in range(150)]
    rows += [(2, k, "user", "Same.") for k in range(150)] + [(2, 200, "assistant", "End.")]
    rows += [(3, k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(151)]
    draw = random.Random(5)
    rows += [(4, k, draw.choice(["user", "assistant", "system"]), f"T{k}" + draw.choice([".", ""])) for k in range(190)]
    assert repaired(frame(spark, rows)) == brute(rows, rows)


def test_damage(spark):
    rows = random_rows(9, 120, 6)
    got = [tuple(r) for r in damaged(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(brute_damage(rows), key=str)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = op12_conversations(spark, sf)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, brute_damage(rows))


def test_nulls_and_empty_tables(spark, tmp_path):
    rows = [(None, None, None, None), (None, 3, "user", None), (5, None, None, "Hi."), (6, 1, "assistant", "x" * 100_000), (7, 0, "user", "Hi."), (7, 0, "user", "Hi.")]
    frame(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    assert sorted(map(tuple, op12_conversations(spark, str(tmp_path)).collect()), key=str) == brute(rows, brute_damage(rows))
    frame(spark, rows).where("false").write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    assert op12_conversations(spark, str(tmp_path / "none")).count() == 0

"""Repaired conversations against a plain search over whole edit strings."""

import hashlib
import random
import zlib

import pytest

from tradewind.llm import conversation_repair as repair
from tradewind.llm.queries import op12_conversation_repair

WHITE = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
OTHER = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        filled = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(":".join(filled).encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else "".join(c for c in text if c not in ".!?") if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def best(rows):
    """Cheapest edits: cost, audit and repaired lines, by whole strings."""
    def inserted(states):
        for s in ("", "s", "a", "u"):
            if s in states:
                cost, audit, lines = states[s]
                offer(states, OTHER[s][0], (cost + 5, audit + "I", lines + [f"{OTHER[s]}:"]))
        return states

    def offer(states, s, found):
        if s not in states or found[:2] < states[s][:2]:
            states[s] = found

    states = {"": (0, "", [])}
    for role, text, fault in rows:
        after = {}
        for s, (cost, audit, lines) in inserted(dict(states)).items():
            offer(after, s, (cost + 2, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if (s, role[:1]) in NEXT:
                    offer(after, NEXT[s, role[:1]], (cost + extra, audit + "K", lines + [f"{role}:{text}"]))
                offer(after, OTHER[s][0], (cost + 1 + extra, audit + "R", lines + [f"{OTHER[s]}:{text}"]))
        states = after
    states = inserted(states)
    states = inserted(states)
    return min((states[s] for s in ("", "a") if s in states), key=lambda x: x[:2])


def brute(rows):
    out = []
    after = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, judged = set(), []
        for _, _, role, text in own:
            bare = text.rstrip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            judged.append((role, text, fault))
        initials = [r[:1] for r, _, _ in judged]
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit, lines = best(judged)
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(sum(f == k for _, _, f in judged) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "turn long, conv_id long, role string, text string, fault string, chunk int"


def check(spark, rows, partitions=4):
    df = spark.createDataFrame([(t, c, r, x, "clash", 1) for c, t, r, x in rows], SCHEMA).repartition(partitions)
    found = sorted((tuple(r[c] for c in COLUMNS) for r in repair.audit(df).collect()), key=str)
    assert found == brute(rows)


def made(seed, conversations, longest):
    draw = random.Random(seed)
    texts = ["Yes.", "no", "", "  ", "Why?", "well \n", "Fine!\n", "ok", "é.", "a" * 50 + "."]
    return [
        (conv, draw.choice([None, t, t, t, t + 3]), draw.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), draw.choice([*texts, None, f"Own {t}.", f"Own {t}."]))
        for conv in range(conversations)
        for t in range(draw.randrange(longest))
    ]


@pytest.mark.parametrize("setting", [{}, {"ROWS": 3}, {"BYTES": 20}])
def test_random_conversations(spark, monkeypatch, setting):
    for name, value in setting.items():
        monkeypatch.setattr(repair, name, value)
    check(spark, made(len(setting) + 5, 60, 14) + [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (7, 2**40, "user", "Far.")])


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(repair, "ROWS", 50)
    check(spark, made(3, 1, 2000) + [(r[0] + 5, *r[1:]) for r in made(4, 3, 30)], 8)


def test_whole_table(spark, sf_dir):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    found = sorted((tuple(r[c] for c in COLUMNS) for r in op12_conversation_repair(spark, sf_dir).collect()), key=str)
    assert found == brute(rows)


def test_empty_and_wholly_dropped(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.audit(empty).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    check(spark, [(dropped, 0, "user", "Gone.")])


def strings(audits, *texts):
    nodes = []
    for text in texts:
        node = 0
        for piece in text:
            node = audits.add(node, piece)
        nodes.append(node)
    return nodes


def test_order_of_audits():
    draw = random.Random(1)
    audits = repair.Audits()
    texts = [[draw.choice(["K", "D", "KK", "RID", "I"]) for _ in range(draw.randrange(12))] for _ in range(80)]
    nodes = strings(audits, *texts)
    for a, x in zip(nodes, texts):
        for b, y in zip(nodes, texts):
            assert audits.less(a, b) == ("".join(x) < "".join(y))


def test_collisions_are_verified(monkeypatch):
    monkeypatch.setattr(repair, "MODULUS", 1)  # every hash is equal
    audits = repair.Audits()
    a, b = strings(audits, "KKD", "KDK")
    assert audits.less(b, a) and not audits.less(a, b)

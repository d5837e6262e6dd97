import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from sheafline.llm import common, conversations

SMALL = "/root/testdata/sf0.001"
PLACES = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        text, role = " " if text is None else text, " " if role is None else role
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv]
        if fault == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        role = "user" if fault == 4 else role
        out[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    return {c: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r))) for c, rs in out.items()}


def cheapest(rows):
    """Dijkstra by (cost, audit) over (turn, last initial): the first time the end is met is the least."""
    seen, out = set(), []
    blank = lambda t: re.search(r"[^\x20\x09-\x0D]", t) is None
    for _, role, text in rows:
        if blank(text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated")
        seen.add((role, text))
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, state, kept = heapq.heappop(queue)
        if at == len(rows) and state in ("", "a"):
            return out, cost, audit, kept
        if (at, state) in done:
            continue
        done.add((at, state))
        go = next(iter(PLACES[state].keys() & {"u", "a"}))
        name = {"u": "user", "a": "assistant"}[go]
        heapq.heappush(queue, (cost + 5, audit + "I", at, go, (kept, f"{name}:")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, state, kept))
            if out[at] in ("", "truncated"):
                more = 5 if out[at] else 0
                if role[:1] in PLACES[state]:
                    heapq.heappush(queue, (cost + more, audit + "K", at + 1, role[:1], (kept, f"{role}:{text}")))
                heapq.heappush(queue, (cost + 1 + more, audit + "R", at + 1, go, (kept, f"{name}:{text}")))


def brute(rows):
    out = []
    for conv, turns in damage(rows).items():
        found, cost, audit, kept = cheapest(turns)
        lines = []
        while kept:
            kept, line = kept
            lines.append(line)
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        counts = [found.count(k) for k in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(reversed(lines)).encode()).hexdigest()
        out.append((-1 if conv is None else conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out)


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def told(df):
    return sorted((-1 if r.conv_id is None else r.conv_id, *[r[n] for n in NAMES[1:]]) for r in df.collect())


def made(spark, rows, partitions=3):
    names = "conv_id long, turn long, role string, text string, part int, begin long, kind string, digest string"
    return spark.createDataFrame([(*r, 1, 2, "k", None) for r in rows], names).repartition(partitions)


def anything(rng, conv, n):
    texts = ["Yes.", "No!", "Why?", "open", "", " \t", "Yes.", "a. b", "End. \n", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    return [(conv, rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.3 else f"t{rng.random()}.") for _ in range(n)]


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in common.read(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert told(conversations.op13_conversation_repair(spark, SMALL)) == brute(rows)


def test_random_and_odd_conversations(spark):
    rng = random.Random(4)
    rows = [r for conv in range(300) for r in anything(rng, conv, rng.randrange(1, 14))]
    rows += anything(rng, None, 9) + [(500, 1, "system", "Be kind.")] * 3 + [(501, 0, "assistant", "x" * 100_000 + ".")]
    assert told(conversations.repair(made(spark, rows))) == brute(rows)


@pytest.mark.parametrize("size", [1, 7])
def test_conversation_in_many_blocks(spark, size):
    rng = random.Random(size)
    rows = [r for conv, n in ((1, 400), (2, 30), (3, 1), (None, 60)) for r in anything(rng, conv, n)]
    rows += [(9, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(300)]
    made_of = conversations.block_rows(conversations.faults(conversations.damaged(made(spark, rows, 8))), size)
    assert made_of.filter("conv_id = 1").count() >= 400 * 0.9 / size
    out = conversations.repair(made(spark, rows, 8), size)
    assert told(out) == brute(rows)


def test_conversation_without_rows_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    out = told(conversations.repair(made(spark, [(gone, 0, "user", "Hello.")], 1)))
    assert out == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_empty_table(spark):
    assert conversations.repair(made(spark, [], 1)).count() == 0

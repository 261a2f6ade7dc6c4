import hashlib
import random
import re
import zlib

import pytest

from placelake.llm import conversations as c
from placelake.llm.common import Scratch

SCHEMA = "conv_id long, turn long, role string, text string, conv string, position string, digest string, kind string, last string"
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)


def damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw, role, text = zlib.crc32(key.encode()) % 20, role or ("" if role == "" else " "), " " if text is None else text
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        yield from [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)


def cheapest(rows):
    """Of all ways, up to two inserts in a gap: the cheapest, and of those the first one."""
    best = None

    def go(k, made, cost, audit):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for inserts in range(3):
            for choice in ([["user"], ["user", "assistant"], ["assistant"], ["assistant", "user"]] if inserts else [[]]):
                if len(choice) != inserts:
                    continue
                now, spent, word = made + [(r, "") for r in choice], cost + 5 * inserts, audit + "I" * inserts
                if k == len(rows):
                    initials = "".join(r[:1] or "-" for r, _ in now)
                    if re.fullmatch(r"(s?(ua)+)?", initials) and (best is None or (spent, word) < best[:2]):
                        best = (spent, word, now)
                    continue
                role, text, fault = rows[k]
                go(k + 1, now, spent + 2, word + "D")
                if fault not in ("blank", "duplicate"):
                    more = 5 if fault == "truncated" else 0
                    go(k + 1, now + [(role, text)], spent + more, word + "K")
                    for new in ("user", "assistant"):
                        go(k + 1, now + [(new, text)], spent + 1 + more, word + "R")

    go(0, [], 0, "")
    return best


def brute(rows, ids):
    out = {}
    for conv in ids:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).digest()))
        seen, marked = set(), []
        for _, _, role, text in own:
            body = text.strip(c.SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        cost, audit, made = cheapest(marked)
        count = [sum(f == name for *_, f in marked) for name in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, *count, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return out


def result(spark, turns, ids, hold):
    found = c.digests(c.repair(turns, Scratch(spark, "test"), ids=ids, hold=hold)).select(c.plain_conv("long").alias("conv_id"), *FIELDS)
    rows = found.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in rows}


def random_rows(seed, n, longest):
    rng = random.Random(seed)
    texts = ["Fine.", "So it is!", "cut off", "", " \n", None, "Is it? ", "no end..", "ünï çødé", "e.g", "x\x85", "a ."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in [None, *range(n)]:
        for k in range(rng.randint(1, longest)):
            rows.append((conv, None if rng.random() < 0.1 else rng.choice([k, k, k, 2 * k, 0]), rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("hold", [0, 1, 4096])
def test_equals_all_ways(spark, hold):
    rows = random_rows(hold, 60, 3)
    turns = frame(spark, rows).repartition(5)
    ids = {r[0] for r in rows}
    assert result(spark, c.damaged(turns), turns, hold) == brute(list(damage(rows)), ids)


def test_spilled_conversations_equal_held_ones(spark):
    rows = random_rows(9, 30, 60) + [(1000, k, ("user", "assistant")[k % 2 if k % 7 else 0], f"Text {k % 900}.") for k in range(5000)]
    turns = frame(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        spilled = result(spark, turns, turns, 3)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert spilled == result(spark, turns, turns, 10**6)
    again = len({(role, text) for conv, _, role, text in rows if conv == 1000})
    assert spilled[1000][2] == 5000 - again and len(spilled[1000][-2]) >= 5000


def test_repaired_turns(spark, scratch):
    turns = frame(spark, [(1, 0, "system", "Rules."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "user", "Well."), (2, 0, "assistant", "Yes.")])
    rows = [tuple(r) for r in c.repair(turns, scratch).filter("position IS NOT NULL").select("conv", "position", "turn", "role", "text", "edit").collect()]
    assert sorted(rows) == [("=1", 0, 0, "system", "Rules.", "K"), ("=1", 1, 1, "user", "Hi.", "K"), ("=1", 2, 3, "assistant", "Well.", "R")]


def test_edges(spark):
    none = frame(spark, [])
    assert result(spark, none, none, 10) == {}
    ids = frame(spark, [(5, 0, "user", "gone"), (None, None, None, None)])
    empty = hashlib.sha256(b"").hexdigest()
    assert result(spark, none, ids, 10) == {5: (0, 0, 0, 0, 0, 0, "", empty), None: (0, 0, 0, 0, 0, 0, "", empty)}
    long = "word " * 400_000 + "."
    rows = [(7, -2**62, "user", long), (7, 2**62, "assistant", long), (2**62 + 1, 3, "user", "One.")] + [(8, 1, "user", "Again.")] * 300
    found = result(spark, frame(spark, rows), frame(spark, rows), 10)
    assert found[7][0] == 2**63 - 1 and found[7][5:7] == (0, "KK")
    assert found[7][-1] == hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest()
    assert found[2**62 + 1][5:7] == (2, "D")
    assert found[8][2] == 299 and found[8][4] == 299 and found[8][6] == "D" * 300

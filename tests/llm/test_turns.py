import hashlib
import heapq
import random
import re
import zlib

import pytest

from pointlake.llm import turn_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, piece long, audit string"
ROLE = {0: "user", 1: "user", 2: "assistant", 3: "user"}


def cheapest(rows, start=0, ends=(0, 3)):
    """(cost, audit, repaired) by uniform-cost search over (initial, role, text, forced, truncated) rows, one per copy."""
    heap, done = [(0, "", 0, start, ())], set()
    while heap:
        cost, audit, i, s, lines = heapq.heappop(heap)
        if (i, s) in done:
            continue
        done.add((i, s))
        if i == len(rows) and s in ends:
            return cost, audit, lines
        to = 3 if s == 2 else 2
        heapq.heappush(heap, (cost + 3, audit + "I", i, to, (*lines, ROLE[s] + ":")))
        if i < len(rows):
            role, text, forced, late = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, s, lines))
            if not forced:
                keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((s, role[:1]))
                if keep is not None:
                    heapq.heappush(heap, (cost + 3 * late, audit + "K", i + 1, keep, (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 3 + 3 * late, audit + "R", i + 1, to, (*lines, f"{ROLE[s]}:{text}")))
    return None


def code(role, text):
    return hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()


def brute(rows):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of rows (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], code(r[1], r[2])))
        seen, judged, n = set(), [], dict.fromkeys("bdt", 0)
        for _, role, text in own:
            shown = text.strip(" \t\n\x0b\x0c\r")
            fault = "b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            n[fault or "b"] += bool(fault)
            judged.append((role, text, fault in ("b", "d"), fault == "t"))
        turns = {t for t, _, _ in own if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest(judged)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["b"], n["d"], n["t"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    fixed = R.repair(df, **kw)
    digests = {r.conv_id: r.repaired_sha256 for r in R.repaired_digests(fixed.turns).collect()}
    found = fixed.conversations.collect()
    assert len(digests) == len(found) == len({r.conv_id for r in found})
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests[r.conv_id]) for r in found}


def some_rows(seed, convs, most):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "Why?", "", " \n", None, "a longer text that ends here!", "cut off", "Yes. "]
    return [(c, rng.choice([None, *range(most)]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""]), rng.choice(texts))
            for c in convs for _ in range(rng.randint(1, most))]


@pytest.mark.parametrize("seed", range(3))
def test_search_is_optimal(seed):
    rng, total = random.Random(seed), R.Search(0, "")
    for _ in range(1500):
        rows = [R.Row(rng.choice("suaax"), rng.random() < 0.2, False, rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randint(0, 9))]
        for r in rows:
            r.truncated = not r.forced and rng.random() < 0.2
        start, ends = rng.choice([(0, (0, 3)), (0, (1,)), (0, (0,)), (1, (3,)), (2, (2,)), (3, (2,)), (3, (3,)), (1, (1,)), (1, (0,))])
        flat = [x for r in rows for x in [(r.initial, "", r.forced, r.truncated)] + [(r.initial, "", True, False)] * r.extra]
        found = R.search(rows, start, ends)
        if found is None:
            assert cheapest(flat, start, (2, 3)) is not None and ends in ((0,), (1,)) and (start != ends[0])
            continue
        assert (found.cost, found.audit) == cheapest(flat, start, ends)[:2]
        total.bounded += found.bounded
    assert total.bounded


def test_bounds_never_exceed_what_a_completion_costs():
    rng = random.Random(7)
    rows = [R.Row(rng.choice("sua"), rng.random() < 0.2, False) for _ in range(12)]
    bounds = R.suffix_bounds(rows, [0, R.INF, R.INF, 0])
    for i in range(13):
        for s in R.STATES:
            assert bounds[i][s] <= R.search(rows[i:], s, (0, 3)).cost


def test_long_pieces_end_soon():
    for initials in ("u" * 512, "ua" * 256, "suaax" * 100):
        found = R.search([R.Row(x, False, False) for x in initials], 0, (0, 3))
        assert found.expanded <= 4 * 512 + 4


@pytest.mark.parametrize("piece", [1, 3, 512])
def test_odd_conversations(spark, piece):
    rows = some_rows(piece, [None, *range(12)], 9)
    rows += [(50, 0, "user", "Same."), (50, 0, "user", "Same."), (50, 9, "user", "Same."), (50, None, "user", "Same."), (51, None, None, None)]
    assert got(spark, rows, piece=piece) == brute(rows)


def test_a_conversation_of_many_pieces(spark):
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant"]), rng.choice(["One.", "two", f"Three {i}."])) for i in range(3 * R.PIECE)]
    rows += [(8, i, ["user", "assistant"][i % 2], f"Text {i}.") for i in range(R.PIECE + 1)] + [(c, 0, "user", "Hi.") for c in range(6)]
    assert got(spark, rows) == brute(rows)


def test_the_repaired_turns_are_the_output(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello."), (1, 2, "user", "Hello."), (1, 3, "user", "More?"), (2, 0, "user", " "), (3, 0, "user", "x")]
    fixed = R.repair(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA))
    turns = {}
    for r in sorted(fixed.turns.collect(), key=lambda r: r.piece):
        turns.setdefault(r.conv_id, []).extend(tuple(t) for t in r.turns)
    assert turns == {1: [("system", "Be kind."), ("user", "Hello."), ("assistant", "More?")], 2: [], 3: []}
    assert {r.conv_id: (r.audit, r.cost) for r in fixed.conversations.collect()} == {1: ("KKDR", 7), 2: ("D", 4), 3: ("D", 4)}


def test_very_long_texts_and_empty_table(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "?"), (1, 1, "assistant", "end" * 300_000 + ".")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == {}


def test_damage(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()] + [(None, None, None, None)]
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        want += [row] * {0: 0, 3: 2}.get(kind, 1)
    df = R.damaged(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.collect())


def test_query_names_every_conversation(spark, tmp_path):
    rows = [(i, 0, "user", "Hi.") for i in range(200)] + [(None, 0, "user", "Hi.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    out = R.op12(spark, str(tmp_path)).collect()
    assert {r.conv_id for r in out} == {r[0] for r in rows} and len(out) == 201
    gone = [r for r in out if zlib.crc32(f"{r.conv_id}:0".encode()) % 20 == 0 and r.conv_id is not None]
    assert gone and all((r.cost, r.audit, r.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest()) for r in gone)

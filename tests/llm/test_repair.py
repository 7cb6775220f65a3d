import hashlib
import itertools
import random

import pytest
from compare import both

from gridloom.llm import queries, repair

TURN = "conv_id long, turn long, role string, text string"
ROLE = {"u": "user", "a": "assistant"}


def best_edits(rows):
    """All edits tried: (cost, audit, lines) of rows (role, text, gone, short)."""
    import re

    top = None
    for runs in itertools.product(("", "u", "a", "ua", "au"), repeat=len(rows) + 1):
        for acts in itertools.product("DKUA", repeat=len(rows)):
            if any(gone and act != "D" for act, (_, _, gone, _) in zip(acts, rows)):
                continue
            cost, audit, initials, lines = 0, "", "", []
            for run, act, row in itertools.zip_longest(runs, acts, rows):
                for x in run:
                    lines.append(f"{ROLE[x]}:")
                cost, audit, initials = cost + 5 * len(run), audit + "I" * len(run), initials + run
                if act in (None, "D"):
                    cost, audit = cost + 2 * (act == "D"), audit + (act or "")
                    continue
                role = row[0] if act == "K" else ROLE[act.lower()]
                cost, audit, initials = cost + (act != "K") + 5 * row[3], audit + ("K" if act == "K" else "R"), initials + (role[:1] or "?")
                lines.append(f"{role}:{row[1]}")
            if re.fullmatch("(s?(ua)+)?", initials) and (top is None or (cost, audit) < top[:2]):
                top = (cost, audit, lines)
    return top


def expected(rows):
    """rows: (turn, role, text) of one conversation, by brute force."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))
    seen, judged, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        blank, again, short = bare == "", (role, text) in seen, bare[-1:] not in (".", "!", "?")
        seen.add((role, text))
        counts["blank"] += blank
        counts["duplicate"] += again and not blank
        counts["truncated"] += short and not again and not blank
        judged.append((role, text, blank or again, short))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = best_edits(judged)
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_edits_by_brute_force(spark):
    rng = random.Random(5)
    convs = {i: [(rng.choice([0, 1, 2, 2, 3, 5, None]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(["a.", "b!", "c", " ", "", None, "d?\n", "a."])) for _ in range(rng.randint(1, 3))] for i in range(120)}
    convs[None] = convs.pop(7)
    rows = [(c, *r, 1) for c, own in convs.items() for r in own]
    df = spark.createDataFrame(rows, TURN + ", at int").repartition(5)
    found, turns = repair.repair_conversations(df)
    digest = {r.conv_id: r.digest for r in repair.digests(turns).collect()}
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digest.get(r.conv_id, hashlib.sha256(b"").hexdigest())) for r in found.collect()}
    assert got == {c: expected(own) for c, own in convs.items()}


def test_a_conversation_over_many_ranges(spark):
    """One conversation holds nearly all rows; its pieces lie in several ranges and give what one piece gives."""
    rng = random.Random(3)
    rows = [(1, i // 2, rng.choice(["user", "assistant", "system", "tool"]), rng.choice([f"{i}.", f"{i}.", f"{i}", "x.", ""])) for i in range(4000)] + [(2, 0, "user", "q."), (2, 1, "assistant", "r.")]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found, turns = repair.repair_conversations(spark.createDataFrame(rows, TURN).repartition(3))
        pieces = turns.filter("conv_id = 1").selectExpr("shiftright(at, 33) as p").distinct().count()
        got = {r.conv_id: r for r in found.collect()}
        own = [(r.role, r.text) for r in turns.filter("conv_id = 1").orderBy("at", "place").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert pieces > 1
    ordered = sorted(rows[:4000], key=lambda r: (r[1], r[2], r[3]))
    seen, kinds, by = set(), [], []
    for _, _, role, text in ordered:
        gone = not text or (role, text) in seen
        seen.add((role, text))
        kinds.append(0 if gone else 1 + 2 * repair.INITIALS.get(role[0], 3) + (text[-1] not in ".!?"))
        by.append((role, text))
    cost, scripts = repair.joined([[repair.Layers().solve(kinds, 0), None, None, None]])
    audit = repair._audit(scripts[0])
    assert (got[1].cost, got[1].audit) == (cost, audit) and got[2].audit == "KK"
    want, at = [], 0
    for letter in scripts[0]:
        if letter in "ua":
            want.append((ROLE[letter], ""))
            continue
        if letter != "D":
            want.append((by[at][0] if letter == "K" else ROLE[letter.lower()], by[at][1]))
        at += 1
    assert own == want


@pytest.mark.parametrize("kinds", [[3], [5], [1], [0], [1, 0, 3, 0], [3, 5] * 50_000])
def test_few_layers_are_worked_out(kinds):
    layers = repair.Layers()
    cost, scripts = repair.joined([[layers.solve(kinds, 0), None, None, None]])
    assert len(scripts[0].translate({ord("u"): None, ord("a"): None})) == len(kinds) and len(layers.layers) < 500


def test_empty_and_long(spark):
    empty = spark.createDataFrame([], TURN)
    found, turns = repair.repair_conversations(empty)
    assert found.count() == 0 and turns.count() == 0 and repair.digests(turns).count() == 0
    long = "x " * 2_000_000 + "."
    found, turns = repair.repair_conversations(spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", " " * 1_000_000)], TURN))
    assert [(r.audit, r.cost, r.blank) for r in found.collect()] == [("DD", 4, 1)]
    assert turns.count() == 0


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (3, None, "user", "b"), (3, None, "user", "b"), (4, 0, None, "c?"), (5, 1, "", "d."), (5, 2, "assistant", "e!")] + [(i, t, r, f"{i} says.") for i in range(10, 60) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    spark.createDataFrame(rows, TURN).write.parquet(str(tmp_path / "c"))
    (tmp_path / "in").mkdir()
    spark.read.parquet(str(tmp_path / "c")).toPandas().to_parquet(tmp_path / "in" / "conversations.parquet")
    a, b = both(spark, queries.QUERIES["op12_conversation_repair"], queries.ORACLE_SQL["op12_conversation_repair"], str(tmp_path / "in"))
    assert a == b and len(a) == 54

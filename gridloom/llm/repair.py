"""Conversation structure repair: the cheapest edits that give role initials ``(s?(ua)+)?``, by a rank-compressed DP.

A layer of the DP stands after each row.  It has four states: nothing yet, after a system, a user or an assistant row.
An edit of a row is a macro: a run of inserted turns, then Keep, Rerole or Delete.  Written as letters, macros are
prefix-free codes, so audits of equally many rows compare like their sequences of codes.  A state therefore keeps no
audit but its cost, the rank of its audit among the layer's, and a pointer to the state before with the macro; audits
are read back along the pointers.  Costs less the smallest, as far as they matter, and ranks make few different layers, so each is
worked out once and then looked up.

Rows are dealt by ranges of (conv_id, turn, role, text), so a conversation of any size lies in pieces of neighbouring
ranges.  The first piece of a range is solved from every state, and pieces are joined by one more DP over them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import stored

BLANKS = " \t\n\x0b\x0c\r"
#: Prices of edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a.  Where each role leads, and the states an end may have.
START, ENDS = 0, (0, 3)
STEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
#: Inserts in a row at most: two more lead back to a state that fits no less.
RUN = 2
#: Any state does what another can for an insert and a delete at most, so a state dearer by more than this leads to no best audit.
SLACK = 2 * (INSERT + DELETE)
ORDER = ["conv_id", "turn", "role", "text"]
ROLES = {"u": "user", "a": "assistant"}
INITIALS = {"s": 0, "u": 1, "a": 2}


def _runs(state: int) -> Iterator[tuple[str, int]]:
    """Inserted turns (u and a) and the state behind them."""
    run = ""
    yield run, state
    for _ in range(RUN):
        role = "a" if state == 2 else "u"
        run, state = run + role, STEP[role, state]
        yield run, state


def _audit(script: str) -> str:
    return script.translate({ord("u"): "I", ord("a"): "I", ord("U"): "R", ord("A"): "R"})


def _macros(kind: int) -> list[list[tuple[int, int, str, str]]]:
    """By state: (next state, cost, audit, script) of all macros for a kind of row: 0 must go; else 1 + 2 * (s, u, a, other) + truncated."""
    role, late = "sua-"[(kind - 1) // 2] if kind else "", TRUNCATED * ((kind - 1) % 2) if kind else 0
    out = []
    for state in range(4):
        found = []
        for run, at in _runs(state):
            price = INSERT * len(run)
            found.append((at, price + DELETE, run + "D"))
            if kind:
                if (role, at) in STEP:
                    found.append((STEP[role, at], price + late, run + "K"))
                found += [(STEP[r, at], price + REROLE + late, run + r.upper()) for r in "ua" if (r, at) in STEP]
        out.append([(to, cost, _audit(script), script) for to, cost, script in found])
    return out


class Layers:
    """The layers met so far, by number, and what each kind of row makes of them."""

    def __init__(self) -> None:
        self.macros = [_macros(k) for k in range(9)]
        self.number: dict[tuple, int] = {}
        self.layers: list[tuple] = []
        self.known: dict[int, tuple] = {}

    def of(self, layer: tuple) -> int:
        if layer not in self.number:
            self.number[layer] = len(self.layers)
            self.layers.append(layer)
        return self.number[layer]

    def next(self, layer: int, kind: int) -> tuple[int, int, tuple]:
        """The layer after a row, what its smallest cost has grown by, and (state before, script) for each state."""
        key = layer * 9 + kind
        if key not in self.known:
            best: list = [None] * 4
            for state, have in enumerate(self.layers[layer]):
                for to, cost, audit, script in self.macros[kind][state] if have else ():
                    way = (have[0] + cost, have[1], audit, state, script)
                    best[to] = way if best[to] is None else min(best[to], way)
            least = min(w[0] for w in best if w)
            best = [w if w and w[0] - least <= SLACK else None for w in best]
            ranks = {w: i for i, w in enumerate(sorted({w[1:3] for w in best if w}))}
            after = tuple(w and (w[0] - least, ranks[w[1:3]]) for w in best)
            self.known[key] = (self.of(after), least, tuple(w and w[3:] for w in best))
        return self.known[key]

    def solve(self, kinds: list[int], start: int) -> list[tuple[int, int, str] | None]:
        """By end state: (cost, rank of the audit among these, script) of the best way through the rows from ``start``."""
        at, total, way = self.of(tuple((0, 0) if s == start else None for s in range(4))), 0, []
        for kind in kinds:
            at, more, back = self.next(at, kind)
            total += more
            way.append(back)
        out: list = []
        for state, have in enumerate(self.layers[at]):
            if have is None:
                out.append(None)
                continue
            scripts = []
            for back in reversed(way):
                state, script = back[state]
                scripts.append(script)
            out.append((total + have[0], have[1], "".join(reversed(scripts))))
        return out


def joined(pieces: list[list]) -> tuple[int, list[str]]:
    """Least cost and each piece's script.  A piece has, by start state, what ``solve`` gives; the last gets the closing inserts."""
    have: list = [(0, 0) if s == START else None for s in range(4)]
    way = []
    for piece in pieces:
        best: list = [None] * 4
        for state, own in enumerate(have):
            for to, there in enumerate(piece[state] or () if own else ()):
                if there:
                    cand = (own[0] + there[0], own[1], there[1], state, there[2])
                    best[to] = cand if best[to] is None else min(best[to], cand)
        ranks = {w: i for i, w in enumerate(sorted({w[1:3] for w in best if w}))}
        have = [w and (w[0], ranks[w[1:3]]) for w in best]
        way.append([w and w[3:] for w in best])
    cost, _, _, state, close = min((own[0] + INSERT * len(run), own[1], "I" * len(run), state, run) for state, own in enumerate(have) if own for run, at in _runs(state) if at in ENDS)
    scripts = []
    for back in reversed(way):
        state, script = back[state]
        scripts.append(script)
    scripts[0] += close
    return cost, scripts[::-1]


def faulty(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text (nulls: one space) with th (hash of the text), blank, short (truncated) and later.

    later: role and text have appeared with a smaller turn.  Only groups of more than one row are joined back for it.
    """
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    bare = F.rtrim("text", F.lit(BLANKS))
    own = own.withColumns({"th": F.sha1("text"), "blank": bare == "", "short": ~F.right(bare, F.lit(1)).isin(".", "!", "?")})
    key = [F.coalesce("conv_id", F.lit(0)).alias("_c"), F.col("conv_id").isNull().alias("_n"), F.col("role").alias("_r"), F.col("th").alias("_t")]
    # a null turn comes first
    seen = own.groupBy(*key).agg(F.count(F.lit(1)).alias("_k"), F.min(F.struct(F.col("turn").isNotNull().alias("some"), F.coalesce("turn", F.lit(0)).alias("turn"))).alias("first")).filter("_k > 1").drop("_k")
    on = (F.coalesce("conv_id", F.lit(0)) == F.col("_c")) & (F.col("conv_id").isNull() == F.col("_n")) & (F.col("role") == F.col("_r")) & (F.col("th") == F.col("_t"))
    late = F.struct(F.col("turn").isNotNull().alias("some"), F.coalesce("turn", F.lit(0)).alias("turn")) > F.col("first")
    return own.join(seen, on, "left").withColumn("later", F.coalesce(late, F.lit(False))).drop("_c", "_n", "_r", "_t", "first")


def _pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation in each range, in order: its counts, its ends, and its solutions."""
    layers, now, one, ranges = Layers(), None, None, set()

    def closed(new: dict, starts: tuple[int, ...]) -> dict:
        kinds = new.pop("kinds")
        new["solved"] = [[{"cost": s[0], "rank": s[1], "script": s[2]} if s else None for s in layers.solve(kinds, p)] if p in starts else None for p in range(4)]
        return new

    for batch in parts:
        out = []
        for conv, part, at, turn, role, th, blank, short, later in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (conv, part) != now:
                if one:
                    out.append(closed(one, starts))
                starts = (START,) if part in ranges else (0, 1, 2, 3)
                ranges.add(part)
                now = (conv, part)
                one = {"conv_id": conv, "part": part, "at": at, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "lo": None, "hi": None, "turns": 0, "first_turn": turn, "last_turn": None, "first": None, "last": None, "kinds": []}
                before = None
            again = later or before == (turn, role, th)
            before = (turn, role, th)
            kind = 0 if blank or again else 1 + 2 * INITIALS.get(role[:1], 3) + short
            one["blank"] += blank
            one["duplicate"] += again and not blank
            one["truncated"] += short and not blank and not again
            if one["first"] is None:
                one["first"] = role[:1]
            else:
                one["illegal"] += one["last"] + role[:1] not in ("su", "ua", "au")
            one["last"] = role[:1]
            if turn is not None:
                one["turns"] += turn != one["last_turn"]
                one["lo"] = turn if one["lo"] is None else one["lo"]
                one["hi"] = one["last_turn"] = turn
            one["kinds"].append(kind)
        yield pa.RecordBatch.from_pylist(out, _PIECES)
    if one:
        yield pa.RecordBatch.from_pylist([closed(one, starts)], _PIECES)


def _whole(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a conversation joined: its counts stand with its first piece, each piece has its script."""

    def done(rows: list[dict]) -> list[dict]:
        head = {n: sum(r[n] for r in rows) for n in ("blank", "duplicate", "truncated", "illegal", "turns")}
        for a, b in zip(rows, rows[1:]):
            head["illegal"] += a["last"] + b["first"] not in ("su", "ua", "au")
            head["turns"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
        some = [r for r in rows if r["lo"] is not None]
        turns = head.pop("turns")
        head["gaps"] = some[-1]["hi"] - some[0]["lo"] + 1 - turns if some else 0
        head["cost"], scripts = joined([[s and [x and (x["cost"], x["rank"], x["script"]) for x in s] for s in r["solved"]] for r in rows])
        blank = dict.fromkeys(head, 0)
        return [{"conv_id": r["conv_id"], "part": r["part"], "at": r["at"], "script": s, **(blank if i else head)} for i, (r, s) in enumerate(zip(rows, scripts, strict=True))]

    now, rows = None, []
    for batch in parts:
        out = []
        for row in batch.to_pylist():
            if rows and row["conv_id"] != now:
                out += done(rows)
                rows = []
            now = row["conv_id"]
            rows.append(row)
        yield pa.RecordBatch.from_pylist(out, _WHOLE)
    if rows:
        yield pa.RecordBatch.from_pylist(done(rows), _WHOLE)


_SOLVED = pa.list_(pa.list_(pa.struct([("cost", pa.int64()), ("rank", pa.int32()), ("script", pa.string())])))
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PIECES = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("at", pa.int64()), *[(c, pa.int64()) for c in (*_COUNTS, "lo", "hi", "turns", "first_turn", "last_turn")], ("first", pa.string()), ("last", pa.string()), ("solved", _SOLVED)])
_WHOLE = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("at", pa.int64()), ("script", pa.string()), *[(c, pa.int64()) for c in (*_COUNTS, "gaps", "cost")]])


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.  Turns: conv_id, at, place, role, text, edit.

    ``rows`` has conv_id, turn, role and text; other columns are ignored, null roles and texts are one space, a null
    conv_id is one conversation.  Rows are taken by turn (nulls first), ties by role, then text; repeated rows are
    neighbours, all but the first of them duplicates.  A row's first fault counts: blank (white space only),
    duplicate (role and text seen earlier), truncated (the last character that isn't white space is none of .!?).
    gaps are the numbers missing between smallest and largest turn, illegal are neighbours whose role
    initials aren't su, ua or au (an empty role has no initial and fits nowhere).

    The audit has the initials of the cheapest edits in order: Keep 0, Rerole to user or assistant 1, Delete 2 (required for
    blank and duplicate rows), Insert a turn without text 5; a truncated row that stays costs 5 more.  Of equally cheap ones it is the
    smallest in ASCII order.  Turns are the repaired conversations, ordered by (at, place).  Texts of any length stay in the JVM, but for
    what digests read.  An empty table gives empty ones.
    """
    ranged = faulty(rows).repartitionByRange(*[F.col(c).asc_nulls_first() for c in ORDER]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ORDER])
    # ranges are cut at sampled bounds, so they are written once; ids go up by one inside a range
    kept, _ = stored(ranged.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).alias("part")
    narrow = kept.select("conv_id", part, "at", "turn", "role", "th", "blank", "short", "later").repartition("part").sortWithinPartitions("part", "at")
    pieces = narrow.mapInArrow(_pieces, _ddl(_PIECES))
    spread = pieces.repartition(F.xxhash64("conv_id")).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part")
    scripts, _ = stored(spread.mapInArrow(_whole, _ddl(_WHOLE)))
    found = scripts.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("gaps", *_COUNTS, "cost")], F.sort_array(F.collect_list(F.struct("part", "script"))).alias("_s"))
    audit = F.translate(F.array_join(F.transform("_s", lambda s: s["script"]), ""), "uaUA", "IIRR")
    # a macro a row, the closing inserts with the last
    codes = scripts.select(F.posexplode(F.regexp_extract_all("script", F.lit(r"([ua]*[KUAD](?:[ua]+\z)?)"), 1)).alias("i", "code"), F.col("at").alias("_first")).select((F.col("_first") + F.col("i")).alias("at"), "code")
    return found.withColumn("audit", audit).drop("_s"), _turns(kept.select("conv_id", "at", "role", "text"), codes)


def _turns(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows with their macros to what stays, what changes and what is new."""

    def made(letter: Column) -> Column:
        role = F.when(F.lower(letter) == "u", ROLES["u"]).when(F.lower(letter) == "a", ROLES["a"]).otherwise(F.col("role"))
        new = letter.isin("u", "a")
        edit = F.when(new, "I").when(letter == "K", "K").otherwise("R")
        return F.struct(role.alias("role"), F.when(new, "").otherwise(F.col("text")).alias("text"), edit.alias("edit"))

    letters = F.filter(F.split("code", ""), lambda x: ~x.isin("", "D"))
    both = rows.join(codes, "at").withColumn("_l", letters)
    return both.select("conv_id", "at", F.posexplode(F.transform("_l", made)).alias("place", "_t")).select("conv_id", "at", "place", "_t.*")


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and sha256 of its turns, as ``role:text`` joined by line feeds.  Turns stream through the hash in order; none are gathered."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hashed = None, None
        for batch in parts:
            out = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if hashed is None or conv != now:
                    if hashed is not None:
                        out.append((now, hashed.hexdigest()))
                    now, hashed = conv, hashlib.sha256()
                else:
                    hashed.update(b"\n")
                hashed.update(line.encode())
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([d for _, d in out], pa.string())], ["conv_id", "digest"])
        if hashed is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([hashed.hexdigest()])], ["conv_id", "digest"])

    ordered = turns.select("conv_id", F.concat_ws(":", "role", "text").alias("line"), "at", "place").repartition(F.xxhash64("conv_id")).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "at", "place")
    return ordered.select("conv_id", "line").mapInArrow(read, "conv_id long, digest string")


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", _SOLVED: "array<array<struct<cost: long, rank: int, script: string>>>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)

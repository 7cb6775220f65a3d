"""SQL for DuckDB of what the shuffles of sharding and mixing rest on: 64-bit hashes of Spark, and the keyed permutation."""

from __future__ import annotations

#: Fixed values of the hash.
P1, P2, P3, P4, P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
M = f"{1 << 64}::UHUGEINT"


def mul(x: str, by: int) -> str:
    return f"(({x}) * {by}::UHUGEINT % {M})"


def rotl(x: str, by: int) -> str:
    return f"(({x}) * {1 << by}::UHUGEINT % {M} + ({x}) // {1 << (64 - by)}::UHUGEINT)"


def folded(x: str, by: int) -> str:
    return f"xor({x}, ({x}) // {1 << by}::UHUGEINT)"


def signed(h: str) -> str:
    return f"({h}::HUGEINT - CASE WHEN {h} >= {1 << 63}::UHUGEINT THEN {1 << 64}::HUGEINT ELSE 0 END)"


def pmod(h: str, by: str) -> str:
    return f"(({signed(h)} % {by} + {by}) % {by})"


def chain(source: str, steps: list[str]) -> str:
    """``source``, whose column h each step replaces in turn."""
    for step in steps:
        source = f"(SELECT * REPLACE ({step} AS h) FROM {source})"
    return source


#: The last steps of each hash.
FINISH = [mul(folded("h", 33), P2), mul(folded("h", 29), P3), folded("h", 32)]


def of_long(column: str) -> list[str]:
    value = f"((({column})::HUGEINT + {1 << 64}::HUGEINT) % {1 << 64}::HUGEINT)::UHUGEINT"
    return [f"xor((h + {P5 + 8}::UHUGEINT) % {M}, {mul(rotl(mul(value, P2), 31), P1)})", f"({mul(rotl('h', 27), P1)} + {P4}::UHUGEINT) % {M}", *FINISH]


def of_int(value: int) -> list[str]:
    return [f"xor((h + {P5 + 4}::UHUGEINT) % {M}, {value * P1 % (1 << 64)}::UHUGEINT)", f"({mul(rotl('h', 23), P2)} + {P3}::UHUGEINT) % {M}", *FINISH]


def of_text(source: str, column: str) -> str:
    """``source`` with h, a hash so far, carried on over a text's bytes; a null text leaves it as it is."""
    little = lambda s, n: "('0x' || " + " || ".join(f"{s}[{i}:{i + 1}]" for i in range(2 * n - 1, 0, -2)) + ")::UBIGINT::UHUGEINT"
    lane = lambda v, k: mul(rotl(f"({v} + {mul(k, P2)}) % {M}", 31), P1)
    start = {"a": (P1 + P2) % (1 << 64), "b": P2, "c": 0, "d": (1 << 64) - P1}
    first = "{" + ", ".join(f"'{x}': (h + {add}::UHUGEINT) % {M}" for x, add in start.items()) + "}"
    stripe = "{" + ", ".join(f"'{x}': _w[4 * i + {j}]" for j, x in enumerate("abcd", 1)) + "}"
    after = "{" + ", ".join(f"'{x}': {lane(f's.{x}', f'k.{x}')}" for x in "abcd") + "}"
    hexed = f"(SELECT *, hex(encode({column})) AS _x FROM {source})"
    words = f"(SELECT *, list_transform(regexp_extract_all(_x, '.{{16}}'), lambda s: {little('s', 8)}) AS _w, right(_x, length(_x) % 16) AS _t, length(_x) // 2 AS _n FROM {hexed})"
    lanes = f"(SELECT *, list_reduce(list_prepend({first}, list_transform(range(_n // 32), lambda i: {stripe})), lambda s, k: {after}) AS _v FROM {words})"
    total = " + ".join(rotl(f"_v.{x}", by) for x, by in zip("abcd", (1, 7, 12, 18), strict=True))
    steps = [f"CASE WHEN _n >= 32 THEN ({total}) % {M} ELSE (h + {P5}::UHUGEINT) % {M} END"]
    steps += [f"CASE WHEN _n >= 32 THEN ({mul(f'xor(h, {mul(rotl(mul(f"_v.{x}", P2), 31), P1)})', P1)} + {P4}::UHUGEINT) % {M} ELSE h END" for x in "abcd"]
    steps.append(f"(h + _n::UHUGEINT) % {M}")
    for j in (1, 2, 3):
        word = f"_w[4 * (_n // 32) + {j}]"
        mixed = f"xor(h, {mul(rotl(mul(word, P2), 31), P1)})"
        steps.append(f"CASE WHEN _n % 32 >= {8 * j} THEN ({mul(rotl(mixed, 27), P1)} + {P4}::UHUGEINT) % {M} ELSE h END")
    mixed = f"xor(h, {mul(little('_t', 4), P1)})"
    steps.append(f"CASE WHEN _n % 8 >= 4 THEN ({mul(rotl(mixed, 23), P2)} + {P3}::UHUGEINT) % {M} ELSE h END")
    for j in (0, 1, 2):
        at = f"(2 * (_n % 8 - _n % 4 + {j}) + 1)"
        mixed = f"xor(h, {mul(f"('0x' || _t[{at}:{at} + 1])::UBIGINT::UHUGEINT", P5)})"
        steps.append(f"CASE WHEN _n % 4 > {j} THEN {mul(rotl(mixed, 11), P1)} ELSE h END")
    done = chain(lanes, [*steps, *FINISH])
    return f"(SELECT * EXCLUDE (_x, _w, _t, _n, _v, _h) REPLACE (CASE WHEN {column} IS NULL THEN _h ELSE h END AS h) FROM (SELECT * FROM {done.replace(source, f'(SELECT *, h AS _h FROM {source})')}))"


def permutation(n: str, seed: int = 1, rounds: int = 6) -> str:
    """Common table expressions ending with placed (x, p): the keyed permutation of 0 to n - 1, walked along its cycles."""
    golden, c1, c2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
    source = "(SELECT v, a, b, n, v % a AS lo, v // a AS hi, 0::UHUGEINT AS h FROM (SELECT unnest(range((a * b)::BIGINT))::UHUGEINT AS v, * FROM ab))"
    for r in range(rounds):
        to, of, size = ("lo", "hi", "a") if r % 2 else ("hi", "lo", "b")
        key = (seed * 64 + r) * golden % (1 << 64)
        mixed = chain(source, [f"({of} + {key}::UHUGEINT) % {M}", mul(folded("h", 30), c1), mul(folded("h", 27), c2), folded("h", 31)])
        source = f"(SELECT * REPLACE (({to} + h % {size}) % {size} AS {to}) FROM {mixed})"
    return f"""size AS (SELECT n::UHUGEINT AS n, greatest(1, ceil(sqrt(n)))::UHUGEINT AS a FROM ({n})),
ab AS (SELECT n, a, greatest(1::UHUGEINT, (n + a - 1) // a) AS b FROM size),
step AS MATERIALIZED (SELECT v, n, hi * a + lo AS w FROM {source}),
walk AS (SELECT v AS x, w AS p, n FROM step WHERE v < n UNION ALL SELECT x, step.w, walk.n FROM walk JOIN step ON step.v = walk.p WHERE walk.p >= walk.n),
placed AS (SELECT x::BIGINT AS x, p::BIGINT AS p FROM walk WHERE p < n)"""

"""Action-string parsing and formatting, table-driven (FIXTURES section 3)."""

import pytest
from pyspark.sql import functions as F

from prefpairs.functions.actions import format_action, parse_actions

PARSES = [
    ("CLICK: (1, 2)", ("CLICK", 1, 2, None)),
    ("  CLICK:(1,2)  ", ("CLICK", 1, 2, None)),
    ("CLICK: 1,2", ("CLICK", 1, 2, None)),
    ("CLICK: ((1,2))", ("CLICK", 1, 2, None)),
    ("CLICK: ( 1 , 2 )", ("CLICK", 1, 2, None)),
    ("CLICK: (1.9, -2.9)", ("CLICK", 1, -2, None)),
    ("CLICK: (1e3, .5)", ("CLICK", 1000, 0, None)),
    ("CLICK: CLICK: (3,4)", ("CLICK", 3, 4, None)),
    ("CLICK: (1_0, 2)", ("CLICK", 10, 2, None)),
    ("CLICK: (5., +3)", ("CLICK", 5, 3, None)),
    ("SCROLL: (1200, -5)", ("SCROLL", 1200, -5, None)),
    ("LONG_PRESS: (0, 0)", ("LONG_PRESS", 0, 0, None)),
    ('TYPE: "hi"', ("TYPE", None, None, "hi")),
    ("TYPE:", ("TYPE", None, None, "")),
    ("TYPE: ''", ("TYPE", None, None, "")),
    ('TYPE: " hi "', ("TYPE", None, None, " hi ")),
    ('TYPE: "TYPE: x"', ("TYPE", None, None, " x")),
    ('TYPE: "a"b"', ("TYPE", None, None, 'a"b')),
    ("COMPLETE", ("COMPLETE", None, None, None)),
    ("COMPLETED!", ("COMPLETE", None, None, None)),
    ("INCOMPLETE", ("INCOMPLETE", None, None, None)),
    ("INCOMPLETE: no", ("INCOMPLETE", None, None, None)),
    ("　CLICK: (7, 8) ", ("CLICK", 7, 8, None)),
]

UNPARSEABLE = [
    "CLICK: (1,2,3)", "CLICK: (1)", "CLICK:", "CLICK: (a, b)", "CLICK: (nan, 1)", "CLICK: (inf,1)",
    "CLICK: (1e3, 5d)", "CLICK: (1,2) ok", "click: (1,2)", "CLICK (1,2)", "xCLICK: (1,2)",
    "SCROLL: up", "STOP", "", "   ", "CLICK: (1__0, 2)", "CLICK: (_1, 2)", "CLICK: (1e30, 2)",
    "CLICK: (._5, 1)", "CLICK: (5._1, 1)", "CLICK: (1_, 1)", "CLICK: (+_1, 1)",
]


def _parse(spark, strings):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i long, s string")
    rows = parse_actions(df, "s").orderBy("i").collect()
    return [(r.action_type, r.x, r.y, r.text) for r in rows]


def test_parse_table(spark):
    got = _parse(spark, [s for s, _ in PARSES])
    for (s, want), g in zip(PARSES, got):
        assert g == want, s


def test_unparseable(spark):
    for s, g in zip(UNPARSEABLE, _parse(spark, UNPARSEABLE)):
        assert g[0] is None, s


def _built_actions(rnd, n):
    """Action strings put together from parts whose reading is known: (string, reading)."""
    from prefpairs.constants import PY_WHITESPACE

    nothing = (None, None, None, None)
    blank = lambda: "".join(rnd.choice(PY_WHITESPACE) for _ in range(rnd.choice([0, 0, 1, 2])))

    def number():
        value, digits = rnd.randint(-3000, 3000), str(rnd.randint(0, 10**6))
        whole = [(str(value), value), (f"{value}.", value), (f"{value}.{digits}", value)]
        if value >= 0:
            whole += [(f"+{value}", value), (f".{digits}", 0), (f"{value}e{value % 7}", value * 10 ** (value % 7)), (f"{value}E+02", value * 100)]
        if value >= 1000:
            whole.append((f"{value // 1000}_{value % 1000:03d}", value))
        return rnd.choice(whole)

    def coordinates():
        tag, (a, x), (b, y) = rnd.choice(["CLICK", "LONG_PRESS", "SCROLL"]), number(), number()
        k, again = rnd.randint(0, 3), rnd.choice(["", "", f" {tag}:"])
        inner = f"{blank()}{a}{blank()},{blank()}{b}{blank()}"
        return f"{blank()}{tag}:{again}{blank()}{'(' * k}{inner}{')' * rnd.randint(0, k)}{blank()}", (tag, x, y, None)

    def typed():
        core = rnd.choice(["", "a", "search query", 'in"ner', "it's", "ünï 中 😀", "x, (1, 2)", "CLICK", " wide "])
        q = rnd.choice(['"', "'", "\"'", '""'])
        return f"{blank()}TYPE:{blank()}{q}{core}{q}{blank()}", ("TYPE", None, None, core)

    def finished():
        tag = rnd.choice(["COMPLETE", "INCOMPLETE"])
        return f"{blank()}{tag}{rnd.choice(['', 'D', ': done', ' (1, 2)'])}{blank()}", (tag, None, None, None)

    def broken():
        (a, _), (b, _), (c, _) = number(), number(), number()
        return rnd.choice([f"CLICK: ({a})", f"SCROLL: ({a}, {b}, {c})", f"LONG_PRESS: ({a}, x{b})", f"click: ({a}, {b})", f"CLICK ({a}, {b})",
                           f"CLICK: ({a}, {b}) now", f"SWIPE: ({a}, {b})", f"CLICK: ({a} {b})", f"CLICK: ({a},)", blank()]), nothing

    return [rnd.choice([coordinates, coordinates, typed, finished, broken])() for _ in range(n)]


def test_parse_of_built_actions(spark):
    import random

    built = _built_actions(random.Random(7), 4000)
    got = _parse(spark, [s for s, _ in built])
    for (s, want), g in zip(built, got, strict=True):
        assert g == want, repr(s)


@pytest.mark.parametrize(
    "row,want",
    [
        (("CLICK", 1, 2, None), "CLICK: (1, 2)"),
        (("CLICK", None, None, None), "CLICK: (0, 0)"),
        (("LONG_PRESS", 0, 0, None), "LONG_PRESS: (0, 0)"),
        (("SCROLL", 5, 6, None), "SCROLL: (5, 6)"),
        (("TYPE", None, None, "hi"), 'TYPE: "hi"'),
        (("TYPE", None, None, ""), 'TYPE: ""'),
        (("TYPE", None, None, None), 'TYPE: ""'),
        (("TYPE", None, None, 'a"b'), 'TYPE: "a"b"'),
        (("COMPLETE", None, None, None), "COMPLETE"),
        (("INCOMPLETE", None, None, None), "INCOMPLETE"),
        (("SWIPE", None, None, None), "STOP"),
    ],
)
def test_format(spark, row, want):
    df = spark.createDataFrame([row], "t string, x long, y long, text string")
    got = df.select(format_action(F.col("t"), F.col("x"), F.col("y"), F.col("text")).alias("a")).first().a
    assert got == want


def test_format_parse_roundtrip(spark):
    rows = [("CLICK", 3, 4, None), ("LONG_PRESS", 1000, 0, None), ("SCROLL", -7, 12, None),
            ("TYPE", None, None, "search query"), ("TYPE", None, None, ""), ("COMPLETE", None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, t string, x long, y long, text string")
    f = df.select("i", format_action(F.col("t"), F.col("x"), F.col("y"), F.col("text")).alias("a"))
    back = parse_actions(f, "a").orderBy("i").collect()
    for r, b in zip(rows, back):
        assert (b.action_type, b.x, b.y, b.text) == r


def test_format_parse_roundtrip_property(spark):
    """parse(format(a)) == a for canonical actions (hypothesis, batched per example)."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from prefpairs.constants import PY_WHITESPACE

    coord = st.integers(min_value=-(2**40), max_value=2**40)
    text = st.text(min_size=0, max_size=30).filter(
        lambda t: "TYPE:" not in t
        and (t == "" or (t[0] not in "\"'" + PY_WHITESPACE and t[-1] not in "\"'" + PY_WHITESPACE))
    )
    action = st.one_of(
        st.tuples(st.sampled_from(["CLICK", "LONG_PRESS", "SCROLL"]), coord, coord, st.none()),
        st.tuples(st.just("TYPE"), st.none(), st.none(), text),
        st.tuples(st.sampled_from(["COMPLETE", "INCOMPLETE"]), st.none(), st.none(), st.none()),
    )

    @settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(action, min_size=300, max_size=300))
    def check(rows):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, t string, x long, y long, text string")
        f = df.select("i", format_action(F.col("t"), F.col("x"), F.col("y"), F.col("text")).alias("a"))
        back = {r.i: (r.action_type, r.x, r.y, r.text) for r in parse_actions(f, "a").collect()}
        for i, r in enumerate(rows):
            assert back[i] == r, (r, back[i])

    check()

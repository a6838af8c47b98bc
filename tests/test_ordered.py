"""Running values by ranges against plain loops, with keys that span many partitions."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from adjudica.operators.ordered import LAST, MAX, SUM, XOR, following, placed, running

ROWS = [(None if i % 17 == 0 else "hot" if i % 3 == 0 else f"k{i % 40}", (i * 7919) % 1009, None if i % 4 else i * 37 % 101) for i in range(900)]


@pytest.fixture
def many(spark, frame):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that the hot key spans partitions
    yield placed(frame("k string, o long, v long", *ROWS), ["k", "o", "v"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def by_key():
    groups = defaultdict(list)
    for k, o, v in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2] is not None, r[2] or 0)):
        groups[k].append((o, v))
    return groups


def fold(values, step):
    held, out = None, []
    for v in values:
        held = v if held is None else held if v is None else step(held, v)
        out.append(held)
    return out


@pytest.mark.parametrize("ahead", [False, True])
def test_running_values_go_on_from_partition_to_partition(many, ahead):
    kinds = {"s": (SUM, lambda a, b: a + b), "m": (MAX, max), "x": (XOR, lambda a, b: a ^ b), "l": (LAST, lambda a, b: b)}
    values = {n: (f, F.col("v")) for n, (f, _) in kinds.items()}
    found = running(many, ["k"], {}, values) if ahead else running(many, ["k"], values)
    assert found.columns == [*many.columns, *kinds]
    got = defaultdict(list)
    for r in found.orderBy("_place").collect():
        got[r.k].append(r)
    assert many.where("k = 'hot'").select("_part").distinct().count() > 1
    for k, items in by_key().items():
        values = [v for _, v in items]
        assert [(r.o, r.v) for r in got[k]] == items
        for name, (_, step) in kinds.items():
            want = fold(values[::-1], step)[::-1] if ahead else fold(values, step)
            assert [r[name] for r in got[k]] == want, (k, name)


def test_both_directions_at_once(many):
    found = running(many, ["k"], {"n": (SUM, F.lit(1))}, {"left": (SUM, F.lit(1))})
    sizes = {k: len(v) for k, v in by_key().items()}
    assert all(r.n + r.left == sizes[r.k] + 1 for r in found.collect())


def test_next_rows_are_found_across_partitions(many):
    found = following(many, ["k"], {"o2": F.col("o"), "v2": F.col("v")})
    got = defaultdict(list)
    for r in found.orderBy("_place").collect():
        got[r.k].append((r.o2, r.v2))
    for k, items in by_key().items():
        assert got[k] == [*items[1:], (None, None)]


def test_empty_tables(frame):
    none = placed(frame("k string, o long"), ["k", "o"])
    assert running(none, ["k"], {"s": (SUM, F.col("o"))}).count() == 0 and following(none, ["k"], {"n": F.col("o")}).count() == 0


def test_no_window_spans_a_whole_key(many):
    plan = running(many, ["k"], {"s": (SUM, F.col("o"))})._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_part" not in line.split("], [")[1]]
    assert all("_asks" in line or "c#" in line for line in windows)

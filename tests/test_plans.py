"""Plan shape: the properties the scale design relies on, read from
``explain('formatted')``."""

import contextlib
import io
import re

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_episode_plan_has_one_shuffle_and_pushdown(spark):
    plan = _plan(entry.queries()["episodes_by_rule"](spark, SF_SMALL))
    shuffles = re.findall(r"hashpartitioning\((\w+)#", plan)
    # readings shuffled once, by sensor; the dimension once, to one row per key
    assert shuffles.count("key") == 1 and len(shuffles) == 2
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert re.search(r"PushedFilters: \[.*In\(event_type", plan)
    assert "Window" in plan and "BroadcastHashJoin" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan   # no UDF


def test_decode_parses_once(spark):
    plan = _plan(entry.queries()["decode_presence"](spark, SF_SMALL))
    assert plan.count("from_json(") == 1, plan


def test_hot_sensors_are_dealt_once(spark):
    """Cut into pieces, the readings are sorted once on the main path and
    exchanged at most three times in all (carries read fewer columns; equal
    exchanges are reused): carries are joined to the rows where they lie."""
    from lampwatch.operators import episodes as E
    from lampwatch.plans import fixture as fx

    eps = E.episodes(fx.actuator(spark, SF_SMALL), fx.presence(spark, SF_SMALL), fx.rule_keys(spark, SF_SMALL),
                     fx.rules(spark), fx.dimension(spark, SF_SMALL), rows_per_chunk=20)
    assert eps.collect()
    plan = _plan(eps)
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    nodes = set(re.findall(r"\((\d+)\)", final))
    dealt = [n for n, by in re.findall(r"\((\d+)\) Exchange\n(?:.+\n)*?Arguments: (.+)", plan)
             if n in nodes and "REPARTITION_BY_NUM" in by]
    assert 1 <= len(dealt) <= 3, dealt
    main = final[:final.index("BroadcastQueryStage")]
    assert main.count("Sort") <= 1
    assert "NestedLoop" not in final and "Cartesian" not in final

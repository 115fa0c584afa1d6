"""Physical-plan properties the scale design relies on."""
from crease.operators import warehouse as WH
from crease.operators.leaderboards import top_batters, top_bowlers
from crease.operators.quality import clean
from crease.operators.scorecard import scorecard_every
from crease.sources.testtables import deliveries_from_events, deliveries_from_lineitem
from tests.conftest import SF_SMALL


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_adapter_scan_is_pruned(spark):
    plan = top_batters(clean(deliveries_from_lineitem(spark, SF_SMALL)))._jdf \
        .queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_discount" not in plan
    assert "TakeOrderedAndProject" in plan                     # top-k, no full sort


def test_bowler_board_has_no_join(spark):
    plan = _plan(top_bowlers(clean(deliveries_from_lineitem(spark, SF_SMALL))))
    assert "Join" not in plan


def test_match_summary_hash_aggregates_the_balls(spark):
    df = WH.wh_match_summary(deliveries_from_lineitem(spark, SF_SMALL))
    # the first aggregate is keyed by (match, venue) and holds only numeric buffers
    phys = _plan(df)
    assert "HashAggregate(keys=[match_id" in phys and "venue" in phys


def test_scorecard_ranks_after_repartition_on_both_keys(spark):
    plan = _plan(scorecard_every(deliveries_from_events(spark, SF_SMALL)))
    assert "hashpartitioning(match_id" in plan and "snapshot" in plan
    assert "REPARTITION_BY_COL" in plan
    assert "SinglePartition" not in plan

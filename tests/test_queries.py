"""Every registered query of the reference's operators against DuckDB, on the smallest data."""

import pytest

from lexiloom.plans import catalog

from .oracle import connect, rows


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    got = catalog.QUERIES[name](spark, sf).toPandas()
    assert len(got.columns) == len(set(got.columns))
    if name in catalog.ORACLES:
        want = duck.sql(catalog.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_flagship(spark, sf):
    assert catalog.flagship(spark, sf).count() > 0


def test_planted_phrases_reach_every_branch(spark):
    from lexiloom.plans import corpus

    m = corpus.metrics(spark, "/root/testdata/sf0.01").toPandas()
    assert m.correction_events.max() > 0 and m.malicious_compliance.max() > 0 and m.tone_shift.max() > 0
    assert m.topic_primary.nunique() >= 5 and m.tone_cluster.nunique() >= 4
    assert m.information_gain.max() > 0.6 and m.information_gain.min() < 0.45
    d = corpus.distilled(spark, "/root/testdata/sf0.01").toPandas()
    assert set(d.quality_tier) == {"gold", "silver", "bronze"} and d.passed.nunique() == 2 and d.selected.sum() < d.passed.sum()

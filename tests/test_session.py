"""Session defaults never override what the cluster (or caller) set."""

from __future__ import annotations

import pytest

from tillandsia.session import SCALE_DEFAULTS, apply_defaults, build_session


def test_defaults_fill_unset_keys(spark):
    for key, value in SCALE_DEFAULTS.items():
        if not spark.sparkContext.getConf().contains(key):
            assert spark.conf.get(key) == value


def test_explicit_settings_win(spark):
    # shuffle partitions was set explicitly by the test session builder.
    apply_defaults(spark, {"spark.sql.shuffle.partitions": "999"})
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def settings_kept(spark):
    """Puts the session's settings back afterwards."""
    before = dict(spark.conf.getAll)
    yield spark
    for key in {*SCALE_DEFAULTS}:
        if key in before:
            spark.conf.set(key, before[key])
        else:
            spark.conf.unset(key)


def test_conf_given_to_build_session_wins_over_defaults(settings_kept):
    assert build_session(conf={SPLIT: "64m"}).conf.get(SPLIT) == "64m"


def test_settings_made_on_the_session_win_over_defaults(settings_kept):
    settings_kept.conf.set(SPLIT, "32m")
    settings_kept.conf.set("spark.sql.adaptive.enabled", "false")
    built = build_session()
    assert built.conf.get(SPLIT) == "32m"
    assert built.conf.get("spark.sql.adaptive.enabled") == "false"


def test_building_again_changes_nothing(settings_kept):
    first = dict(build_session().conf.getAll)
    assert dict(build_session().conf.getAll) == first

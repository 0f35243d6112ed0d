from __future__ import annotations

import datetime as dt

import pytest

from submart.specs import RunContext, ScdKind, SourceSpec, TargetSpec


def test_kind_parse():
    assert ScdKind.parse("delta_scd4") is ScdKind.DELTA_SCD4
    with pytest.raises(ValueError):
        ScdKind.parse("SCD2")


def test_source_validation():
    with pytest.raises(ValueError):
        SourceSpec(name="x", kind="DELTA_SCD4", active="a", hist="h")  # no keys / ts
    with pytest.raises(ValueError):
        SourceSpec(name="x", kind="CURRENT_SCD1", location="t", window_days=3)  # no ts
    with pytest.raises(ValueError):
        SourceSpec(name="x", kind="SNAPSHOT", location="t")
    s = SourceSpec(name="x", kind="DELTA_SCD4", active="a", hist="h", keys="k1, k2",
                   ts_column="ts")
    assert s.keys == ("k1", "k2")


def test_target_validation():
    with pytest.raises(ValueError):
        TargetSpec(name="t", location="/x", partition_columns="d", columns=("d", "a"))
    with pytest.raises(ValueError):
        TargetSpec(name="t", location="/x", partition_columns=())
    t = TargetSpec(name="t", location="/x", partition_columns="d", columns=("a", "d"))
    assert t.partition_columns == ("d",)


def test_run_context():
    ctx = RunContext(dt.date(2024, 1, 25), dt.date(2024, 1, 25))
    assert ctx.reads_active and ctx.iso == "2024-01-25"

import os

import pytest

from ledgerloop.plans import case_store, detection
from ledgerloop.plans.detection import Settings

RING = [("1_a", "2_b", 5, 0), ("2_b", "3_c", 6, 1), ("3_c", "1_a", 7, 2), ("4_d", "5_e", 1, 3)]


@pytest.fixture
def searches(monkeypatch):
    """How often cycles were searched."""
    calls = []
    real = detection.find_cases
    monkeypatch.setattr(detection, "find_cases", lambda *a: calls.append(1) or real(*a))
    return calls


def paths(df):
    return sorted(r["path"] for r in df.collect())


def test_cases_are_searched_again_only_when_the_input_changes(spark, make_transfers, tmp_path, searches):
    source, store = str(tmp_path / "transfers"), str(tmp_path / "store")
    make_transfers(RING).write.parquet(source)
    found = case_store.stored_cases(spark, source, store)
    assert paths(found) == ["1_a -> 2_b -> 3_c -> 1_a"] and len(searches) == 1
    again = case_store.stored_cases(spark, source, store)
    assert again.collect() == found.collect() and len(searches) == 1
    # Other settings, then another file.
    assert paths(case_store.stored_cases(spark, source, store, Settings(max_cycle_length=2))) == []
    assert len(searches) == 2
    make_transfers([("5_e", "4_d", 2, 9)]).write.mode("append").parquet(source)
    assert len(paths(case_store.stored_cases(spark, source, store))) == 2 and len(searches) == 3
    case_store.stored_cases(spark, source, store)
    assert len(searches) == 3


def test_a_version_that_broke_off_is_written_again(spark, make_transfers, tmp_path, searches):
    source, store = str(tmp_path / "transfers"), str(tmp_path / "store")
    make_transfers(RING).write.parquet(source)
    case_store.stored_cases(spark, source, store)
    version = case_store.version_of(spark, source, Settings())
    os.remove(f"{store}/version={version}/_SUCCESS")
    assert len(paths(case_store.stored_cases(spark, source, store))) == 1 and len(searches) == 2


def test_an_input_without_cycles_is_not_searched_twice(spark, make_transfers, tmp_path, searches):
    source, store = str(tmp_path / "transfers"), str(tmp_path / "store")
    make_transfers(RING[:2]).write.parquet(source)
    for _ in range(2):
        found = case_store.stored_cases(spark, source, store)
        assert found.collect() == [] and "risk_level" in found.columns
    assert len(searches) == 1

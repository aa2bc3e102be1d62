import pytest
from hypothesis import given
from hypothesis import strategies as st

from sluice.functions.names import (NameCollisionError, keyword_columns, normalize_name,
                                    plan_normalized_names, plan_renames)
from sluice.operators.columns import normalize_names, rename_map
from sluice.plans.presets import RENAME_MAP


@pytest.mark.parametrize("raw,expected", [
    ("CMS Certification Number (CCN)", "cms_certification_number_ccn"),
    (" Zip-Code ", "zip_code"),
    ("Rate/Day", "rate_day"),
    ("a.b", "a_b"),
    ("x,y", "x,y"),
    ("Pct %", "pct_%"),
    ("a  b", "a__b"),          # runs of '_' are kept
    ("Time: AM", "time:_am"),
])
def test_normalize_name(raw, expected):
    assert normalize_name(raw) == expected


def test_header_then_rename_map_gives_facility_number():
    names = plan_normalized_names(["CMS Certification Number (CCN)", "Provider Name"])
    assert plan_renames(names, RENAME_MAP) == ["facility_number", "facility_name"]


@given(st.lists(st.text(max_size=12), max_size=6))
def test_normalize_idempotent(names):
    once = [normalize_name(n) for n in names]
    assert [normalize_name(n) for n in once] == once


@given(st.lists(st.text(alphabet="aAbB -_.()/", max_size=5), max_size=8))
def test_suffix_mode_never_collides(names):
    out = plan_normalized_names(names, on_collision="suffix")
    assert len({n.lower() for n in out}) == len(out)


def test_d3_collision_is_caught_before_data(spark):
    # 'Zip Code' and 'Zip-Code' both normalize to zip_code; 'State'/'STATE ' to state
    df = spark.createDataFrame([("1", "2", "3", "4")], ["Zip Code", "Zip-Code", "State", "STATE "])
    with pytest.raises(NameCollisionError):
        normalize_names(df)
    out = normalize_names(df, on_collision="suffix")
    assert out.columns == ["zip_code", "zip_code_2", "state", "state_2"]
    assert out.collect()[0] == ("1", "2", "3", "4")


def test_rename_case_insensitive_and_missing_ignored(spark):
    df = spark.createDataFrame([(1, 2)], ["Provider_Name", "other"])
    out = rename_map(df, {" provider_name ": "facility_name", "absent": "x"})
    assert out.columns == ["facility_name", "other"]


def test_rename_target_collision_detected(spark):
    df = spark.createDataFrame([(1, 2)], ["provider_name", "facility_name"])
    with pytest.raises(NameCollisionError):
        rename_map(df, RENAME_MAP)


def test_keywords_loose_substring_d18():
    cols = ["facility_number", "overall_rating", "staffing_rating", "staffing_rating_footnote",
            "reported_hours_per_resident", "total_turnover", "case_mix_index", "adjusted_total",
            "rating_cycle_1_score", "health_deficiency_score", "revisit_score_1",
            "total_weighted_health_survey_score", "generating_capacity", "staff_count"]
    rating = keyword_columns(cols, ["rating", "footnote", "facility_number"])
    assert "generating_capacity" in rating and "staffing_rating_footnote" in rating
    assert "staff_count" not in rating
    staffing = keyword_columns(cols, ["facility_number", "staffing", "hours_per", "turnover",
                                      "case_mix", "adjusted"])
    assert staffing == ["facility_number", "staffing_rating", "staffing_rating_footnote",
                        "reported_hours_per_resident", "total_turnover", "case_mix_index",
                        "adjusted_total"]
    assert keyword_columns(["Rating"], ["rating"]) == []   # case-sensitive

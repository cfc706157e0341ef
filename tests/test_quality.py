from __future__ import annotations

import pytest

from tallywright.operators import quality
from tallywright.schemas import EXPECTATION_RESULT


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", 5), (2, "b", None), (2, "c", 99), (None, None, 7), (None, "a", 7)],
        "id int, code string, n int",
    )


def outcome(df, *expectations):
    return {
        r["expectation"]: (r["checked_rows"], r["failed_rows"], r["success"])
        for r in quality.check(df, expectations).collect()
    }


def test_each_kind(rows):
    got = outcome(
        rows,
        quality.not_null("id"),
        quality.in_set("code", ["a", "b"]),
        quality.in_range("n", 5, 10),
        quality.unique("id"),
        quality.unique("id", "code"),
    )
    assert got == {
        "not_null(id)": (5, 2, False),
        "in_set(code)": (5, 1, False),
        "in_range(n)": (5, 1, False),
        "unique(id)": (3, 2, False),
        "unique(id,code)": (3, 0, True),
    }


def test_result_schema(rows):
    result = quality.check(rows, [quality.not_null("n"), quality.unique("n")])
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in EXPECTATION_RESULT
    ]


def test_only_unique_checks_on_an_empty_table(rows):
    empty = rows.filter("false")
    assert outcome(empty, quality.unique("id")) == {"unique(id)": (0, 0, True)}
    assert outcome(empty, quality.not_null("id")) == {"not_null(id)": (0, 0, True)}


def test_failure_halts_and_success_passes(rows):
    with pytest.raises(quality.DataQualityError, match=r"not_null\(id\): 2 rows"):
        quality.halt_on_failure(quality.check(rows, [quality.not_null("id")]))
    good = quality.check(rows, [quality.in_range("n", 0, 100)])
    assert quality.halt_on_failure(good) is good


def test_require_rows(rows):
    assert quality.require_rows(rows, 5, "rows") == 5
    with pytest.raises(RuntimeError, match="found 5"):
        quality.require_rows(rows, 6, "rows")


def test_no_expectations_give_no_results(rows):
    empty = quality.check(rows, [])
    assert empty.count() == 0 and "success" in empty.columns
    quality.halt_on_failure(empty)

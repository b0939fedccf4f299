"""Property test: the distributed gate equals a direct row-by-row restatement."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidepool.operators import quality

RULES = {"columns": ["id", "price", "cat"], "not_null": ["id", "cat"], "unique": ["id"],
         "checks": [{"type": "min_value", "column": "price", "min": 0},
                    {"type": "accepted_values", "column": "cat", "values": ["a", "b"]}]}

rows_strategy = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.integers(-3, 3)),
              st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
    min_size=0, max_size=25)


def expected(rows):
    n = len(rows)
    out = [("columns", "PASS", "3 columns match"), ("row_count", "PASS", f"{n} rows match")]
    nulls = [c for i, c in [(0, "id"), (2, "cat")] if any(r[i] is None for r in rows)]
    out.append(("not_null", "FAIL", f"nulls found in {nulls}") if nulls
               else ("not_null", "PASS", "no nulls in required columns"))
    ids = [r[0] for r in rows]
    dup = len(ids) != len(set(ids))
    out.append(("unique", "FAIL", "duplicates in ['id']") if dup else ("unique", "PASS", "['id'] unique"))
    neg = sum(1 for r in rows if r[1] is not None and r[1] < 0)
    out.append(("min_value.price", "FAIL", f"{neg} rows < 0") if neg else ("min_value.price", "PASS", "all >= 0"))
    bad = sum(1 for r in rows if r[2] is not None and r[2] not in ("a", "b"))
    out.append(("accepted_values.cat", "FAIL", f"{bad} rows outside ['a', 'b']") if bad
               else ("accepted_values.cat", "PASS", "all values accepted"))
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_gate_matches_direct_restatement(spark, rows):
    df = spark.createDataFrame(rows, "id long, price long, cat string")
    got = [(r.check_name, r.status, r.detail) for r in quality.gate(df, "t", RULES).orderBy("check_order").collect()]
    assert got == expected(rows)

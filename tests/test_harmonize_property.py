"""harmonize_columns on random header layouts against a plain-Python model of the rule."""

from hypothesis import given, settings
from hypothesis import strategies as st

from regstar.domain import registrations as R
from regstar.operators.harmonize import harmonize_columns

aliases = sorted(R.HEADER_ALIASES)
header = st.one_of(
    st.sampled_from(aliases).map(lambda a: a.upper()),
    st.sampled_from(aliases).map(lambda a: f" {a} "),
    st.sampled_from(aliases),
    st.sampled_from(["junk", "x.y", "notes"]),
)


def model(headers, row):
    out = {}
    for target in R.GOLDEN_COLUMNS:
        vals = [v for h, v in zip(headers, row) if R.HEADER_ALIASES.get(h.lower().strip()) == target]
        out[target] = next((v for v in vals if v is not None), None)
    return tuple(out[c] for c in R.GOLDEN_COLUMNS)


@settings(max_examples=10, deadline=None)
@given(st.lists(header, min_size=1, max_size=8),
       st.lists(st.lists(st.one_of(st.none(), st.text(alphabet="ab1", max_size=3)), min_size=8, max_size=8),
                min_size=1, max_size=5))
def test_harmonize_matches_model(spark, headers, rows):
    rows = [tuple(r[: len(headers)]) for r in rows]
    names = [f"c{i}" for i in range(len(headers))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = [tuple(r) for r in harmonize_columns(df, headers=headers).collect()]
    assert got == [model(headers, r) for r in rows]

"""K6 semantics as a property: upsert = stage rows + target rows whose key is not staged."""

from hypothesis import given, settings, strategies as st

from fleetlake.operators.merge import upsert_frames

keys = st.integers(min_value=0, max_value=6)
vals = st.one_of(st.none(), st.integers(min_value=-5, max_value=5))


@settings(max_examples=12, deadline=None)
@given(target=st.dictionaries(keys, vals, max_size=6), stage=st.dictionaries(keys, vals, max_size=6))
def test_upsert_matches_dictionary_update(spark, target, stage):
    schema = "k long, v long"
    t = spark.createDataFrame(list(target.items()), schema)
    s = spark.createDataFrame(list(stage.items()), schema)
    got = {r.k: r.v for r in upsert_frames(t, s, ["k"]).collect()}
    want = {**target, **stage}                      # insert new, replace on match, never delete
    assert got == want
    assert upsert_frames(t, s, ["k"]).count() == len(want)

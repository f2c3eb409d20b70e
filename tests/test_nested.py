from strata import schemas
from strata.operators import clean, nested
from strata.sources import files


def test_unequal_lists_are_padded(spark):
    df = spark.createDataFrame(
        [("a", "n", ["x", "y"], ["1"]), ("b", "n", None, ["1"]), ("c", "n", [], []), ("d", "n", [""], [""])],
        "id string, name string, artists array<string>, artist_ids array<string>",
    )
    got = {tuple(r) for r in nested.normalize_artists(df).collect()}
    assert got == {("a", "n", "x", "1"), ("a", "n", "y", None), ("d", "n", "", "")}


def test_flatten_any_depth_and_odd_names(spark):
    df = spark.sql("select 1 as a, named_struct('b c', named_struct('d', 2, 'e.f', array(3)), 'g', 'x') as s")
    flat = nested.flatten_struct(df)
    assert flat.columns == ["a", "s.b c.d", "s.b c.e.f", "s.g"]
    assert tuple(flat.first()) == (1, 2, [3], "x")


def test_null_struct_flattens_to_nulls(spark):
    df = spark.createDataFrame([(None,)], "s struct<a: int, b: struct<c: int>>")
    assert tuple(nested.flatten_struct(df).first()) == (None, None)


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, "z")], "x int, z string")
    got = {tuple(r) for r in nested.union_by_name([a, b]).collect()}
    assert got == {(1, 2, None), (3, None, "z")}


def test_track_becomes_a_raw_song_that_cleans(spark):
    track = (
        "t1", "Song", ("al", "Album", "2001-02-03"), [("a1", "A"), ("a2", "B")], 3, 1, True, 61500, 7,
    )
    df = spark.createDataFrame([(track,), (None,)], f"record {schemas.track_schema().simpleString()}")
    raw = nested.track_to_raw_song(df)
    assert raw.schema.simpleString() == schemas.raw_song_schema().simpleString()
    row = clean.clean_songs(raw).first()
    assert (row["artists"], row["artist_ids"], row["duration_ms"], row["year"]) == (["A", "B"], ["a1", "a2"], 62.0, 2001)
    assert row["explicit"] is True and row["tempo"] is None and str(row["release_date"]) == "2001-02-03"
    assert [tuple(r) for r in nested.track_popularity(df).collect()] == [("t1", 7)]


def test_variants_of_clashing_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":1,"x":5,"o":{"a b":1,"l":["p"],"it\'s":true}},{"id":2,"x":{"k":"v"},"z":null,"e":{}}]')
    (tmp_path / "b.json").write_text('{"id":3,"x":"t","o":{"a b":2.5,"l":[1,null]},"d":[1,2]}')
    df = nested.flatten_variants(files.read_variants(spark, str(tmp_path)))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    assert kinds == {
        "d": "array<bigint>", "e": "string", "id": "bigint", "o.a b": "double", "o.it's": "boolean", "o.l": "string", "x": "string", "z": "string"
    }
    got = [tuple(r) for r in df.select("id", "x", "`o.a b`", "`o.l`", "`o.it's`", "z", "e", "d").orderBy("id").collect()]
    assert got == [
        (1, "5", 1.0, '["p"]', True, None, None, None), (2, '{"k":"v"}', None, None, None, None, "{}", None),
        (3, "t", 2.5, "[1,null]", None, None, None, [1, 2]),
    ]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.json").write_text("[1, [2]]")
    plain = nested.flatten_variants(files.read_variants(spark, str(tmp_path / "c")))
    assert sorted(r.value for r in plain.collect()) == ["1", "[2]"]

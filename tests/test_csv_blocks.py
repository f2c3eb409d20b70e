import random

import pytest

from strata.sources import csv_blocks, files, zones

PIECES = ['"', '""', ",", "\n", "a", "b c", "\r\n", "é", '"x,\ny"', " "]


def step(state, byte):
    """The parser's state machine, byte by byte."""
    if state == csv_blocks.QUOTED:
        return csv_blocks.QUOTE if byte == 34 else state
    if byte == 34 and state in (csv_blocks.RECORD, csv_blocks.FIELD, csv_blocks.QUOTE):
        return csv_blocks.QUOTED
    return {10: csv_blocks.RECORD, 44: csv_blocks.FIELD}.get(byte, csv_blocks.PLAIN)


def walked(data, state):
    """The state at the end, and where records begin."""
    begins = [0] if state == csv_blocks.RECORD and data else []
    for i, byte in enumerate(data):
        state = step(state, byte)
        if state == csv_blocks.RECORD and i + 1 < len(data):
            begins.append(i + 1)
    return state, begins


def test_summaries_equal_the_machine():
    chance = random.Random(5)
    for _ in range(20000):
        data = "".join(chance.choices(PIECES, k=chance.randint(0, 8))).encode()
        data = data[: chance.randint(0, len(data))]
        ends, firsts = csv_blocks.summary(data)
        for state in range(5):
            end, begins = walked(data, state)
            assert (ends[state], firsts[state]) == (end, begins[0] if begins else -1), (data, state)
        starts, stops, fields = csv_blocks.records(data)
        _, begins = walked(data, csv_blocks.RECORD)
        whole = [data[a:b] for a, b in zip(begins, [*begins[1:], len(data)])]
        cut = lambda r: r[:-1].removesuffix(b"\r") if r.endswith(b"\n") else r
        text = [r if walked(r, 0)[0] == csv_blocks.QUOTED else cut(r) for r in whole]
        assert [data[a:b] for a, b in zip(starts, stops)] == [r for r in text if r]


@pytest.mark.parametrize("block", [5, 64, 1 << 20])
def test_rows_are_those_of_the_parser(spark, tmp_path, block):
    chance = random.Random(block)
    fields = ["x", "", '"a, b"', '"two\nlines"', '"say ""hi"""', '5" disc', '"a"b', " spaced ", "é", '""', "nan", '"\n"', '",\n"""']
    for no in range(3):
        rows = [",".join([str(i), *chance.choices(fields, k=chance.choice([1, 2, 2, 2, 3]))]) for i in range(80)]
        ends = "\r\n" if no == 1 else "\n"
        (tmp_path / "in").mkdir(exist_ok=True)
        body = ends.join(["id,a,b", *rows]) + (ends if no != 2 else "")
        (tmp_path / "in" / f"f{no}+ x.csv").write_bytes((b"\xef\xbb\xbf" if no == 2 else b"") + body.encode())
    (tmp_path / "in" / "empty.csv").write_text("")
    read = lambda **how: files.read_csv(spark, str(tmp_path / "in"), malformed="aside", source_column="f", **how)
    want, got = (sorted(map(repr, read(**how).collect())) for how in ({}, {"block": block}))
    assert got == want and len(got) > 150
    bad = lambda **how: sorted(map(tuple, files.malformed_csv(spark, str(tmp_path / "in"), **how).collect()))
    same = lambda rows: [(f, line.replace("\r\n", "\n")) for f, line in rows]
    assert same(bad(block=block)) == same(bad()) and bad()
    with pytest.raises(Exception, match="more than 3 fields"):
        files.read_csv(spark, str(tmp_path / "in"), block=block).collect()


def test_a_file_is_read_by_several_tasks(spark, tmp_path):
    text = "id,note\n" + "".join(f'{i},"line\nand, line ""{i}"""\n' for i in range(5000))
    (tmp_path / "a.csv").write_text(text)
    df = files.read_csv(spark, str(tmp_path), block=4096)
    assert df.selectExpr("spark_partition_id() p").distinct().count() > 4
    assert df.selectExpr("sum(cast(id as int))", "count(distinct note)").first()[:] == (sum(range(5000)), 5000)
    ranges = csv_blocks.csv_ranges(spark, files.listed(spark, str(tmp_path), "*.csv"), 4096).collect()
    raw = text.encode()
    assert all(r.at == 0 or raw[: r.at].endswith(b'"\n') for r in ranges) and sum(r.n for r in ranges) == len(raw)


def test_odd_files(spark, tmp_path):
    def folder(name, **named):
        (tmp_path / name).mkdir()
        for f, text in named.items():
            (tmp_path / name / f"{f}.csv").write_text(text)
        return str(tmp_path / name)

    assert files.read_csv(spark, folder("header", a="id,name\n"), block=4).collect() == []
    assert files.read_csv(spark, folder("none", a=""), block=4).collect() == []
    with pytest.raises(Exception, match="another header"):
        files.read_csv(spark, folder("two", a="id,name\n1,x\n", b="name,id\nx,1\n"), block=4).collect()
    unclosed = folder("unclosed", a='id,name\n1,"x\n' + "2,y\n" * 1000)
    found = files.listed(spark, unclosed, "*.csv")
    with pytest.raises(Exception, match="more than 500 bytes"):
        csv_blocks.csv_records(spark, found, block=64, longest=500).collect()
    with pytest.raises(Exception, match="no header"):
        files.read_csv(spark, folder("blank", a="\n" * 100 + "id,name\n1,x\n"), block=16).collect()
    odd = folder("names", a='id,a`b,"x.y, z"\n1,2,3\n')
    blank = folder("blank_name", a="id,,x\n1,2,3\n")
    assert files.read_csv(spark, blank, block=3).first().asDict() == {"id": "1", "_c1": "2", "x": "3"}
    assert files.read_csv(spark, odd, block=3).first().asDict() == files.read_csv(spark, odd).first().asDict()


def test_types_and_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.csv").write_text('n,big,x,flag,s,day,none\n1,9999999999,1.5,true,"a\nb",2024-03-31,\n,2,2e3,FALSE,7,x,\n')
    kinds = [f.dataType.simpleString() for f in files.inferred_schema(spark, str(tmp_path / "in"), block=8)]
    assert kinds == ["int", "bigint", "double", "boolean", "string", "string", "string"]
    assert kinds == [f.dataType.simpleString() for f in files.inferred_schema(spark, str(tmp_path / "in"))]
    assert zones.ingest_csv(spark, str(tmp_path / "in"), str(tmp_path / "zone"), drop=["flag"], block=8) == 1
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "zone")).collect()}
    assert got == {(1, 9999999999, 1.5, "a\nb", "2024-03-31", None, "one"), (None, 2, 2000.0, "7", "x", None, "one")}

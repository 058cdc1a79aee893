import datetime as dt
import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from rowhaul.plans.jobs import import_records
from rowhaul.sinks.committed import CommittedTable
from rowhaul.sinks.files import FORMATS, write_records
from rowhaul.sources.files import BadLine, jsonl_violations, line_named, read_csv, read_json_array, read_jsonl, read_records

AWKWARD = [
    (1, None), (2, ""), (3, "\\N"), (4, "\\\\N"), (5, " leading and trailing "), (6, "a,b"), (7, 'say "hi"'), (8, "two\nlines"),
    (9, "日本語"), (10, "é"), (11, "cr\rx"), (12, "crlf\r\nx"), (13, '"'), (14, "\\"), (15, "tab\t"), (16, "end\r"), (17, "#c"),
    (18, 'comma, quote " and newline\n'),
]
UUID = "6f9619ff-8b86-d011-b42d-00c04fc964ff"


def _file(tmp_path, content, name="in.txt"):
    path = tmp_path / name
    path.write_bytes(content.encode("utf-8") if isinstance(content, str) else content)
    return str(path)


@pytest.mark.parametrize("fmt", FORMATS)
def test_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame(AWKWARD, "id long, text string").repartition(3, "id")
    write_records(df, f"{tmp_path}/out", fmt)
    back = read_records(spark, f"{tmp_path}/out", fmt)
    assert sorted((int(r.id), r.text) for r in back.collect()) == [(i, t) for i, t in AWKWARD]


@pytest.mark.parametrize("fmt", FORMATS)
def test_no_rows(spark, tmp_path, fmt):
    write_records(spark.createDataFrame([], "id long"), f"{tmp_path}/out", fmt)
    if fmt == "json":
        assert {open(p).read() for p in glob.glob(f"{tmp_path}/out/part*")} == {"[]\n"}
    with pytest.raises(ValueError, match="not one record"):
        back = read_records(spark, f"{tmp_path}/out", fmt)
        if back.count() == 0:  # CSV: the header alone fixes the columns
            raise ValueError("no records")


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        read_records(spark, str(tmp_path), "xml")
    with pytest.raises(ValueError):
        write_records(spark.range(1), f"{tmp_path}/x", "xml")


def test_extended_json_dates(spark, tmp_path):
    rows = [(dt.date(2026, 9, 26),), (None,), (dt.date(1899, 12, 31),)]
    df = spark.createDataFrame(rows, "day date")
    write_records(df, f"{tmp_path}/days", "extended-json")
    lines = {r.value for r in spark.read.text(f"{tmp_path}/days").collect()}
    assert '{"day":{"$date":"2026-09-26T00:00:00.0000000"}}' in lines
    assert {tuple(r) for r in read_jsonl(spark, f"{tmp_path}/days", extended=True, schema=df.schema).collect()} == set(rows)


def test_extended_json_keeps_types(spark, tmp_path):
    schema = T.StructType([
        T.StructField("long", T.LongType()), T.StructField("decimal", T.DecimalType(38, 9)), T.StructField("date", T.TimestampType()),
        T.StructField("uuid", T.StringType(), True, {"logical": "uuid"}), T.StructField("binary", T.BinaryType()),
    ])
    row = (9223372036854775807, Decimal("1.25"), dt.datetime(2026, 9, 26, 12, 34, 56, tzinfo=dt.timezone.utc), UUID, b"\x01\x02\x03")
    df = spark.createDataFrame([row], schema)
    write_records(df, f"{tmp_path}/out", "extended-json")
    back = read_records(spark, f"{tmp_path}/out", "extended-json")
    assert [f.dataType for f in back.schema.fields] == [f.dataType for f in schema.fields]
    assert back.schema["uuid"].metadata == {"logical": "uuid"}
    assert back.collect() == df.collect()


def test_numbers_read_as_decimal(spark, tmp_path):
    for read, text in ((read_json_array, '[{"v":1},{"v":1.5},{"v":1e3},{"v":null}]'), (read_jsonl, '{"v":1}\n{"v":1.5}\n{"v":1e3}\n{"v":null}\n')):
        df = read(spark, _file(tmp_path, text, read.__name__))
        assert df.schema["v"].dataType == T.DecimalType(38, 9)
        assert [r.v for r in df.collect()] == [Decimal(1), Decimal("1.5"), Decimal(1000), None]


def test_local_and_offset_dates(spark, tmp_path):
    df = read_jsonl(spark, _file(tmp_path, '{"date":{"$date":"2026-09-26T12:34:56.0000000"}}'), extended=True)
    assert df.schema["date"].dataType == T.TimestampNTZType() and df.first().date == dt.datetime(2026, 9, 26, 12, 34, 56)
    df = read_jsonl(spark, _file(tmp_path, '{"date":{"$date":"2026-09-26T12:34:56+02:00"}}', "b"), extended=True)
    assert df.schema["date"].dataType == T.TimestampType()
    assert df.select(F.col("date").cast("string")).first()[0] == "2026-09-26 10:34:56"


def test_later_values_take_the_first_records_types(spark, tmp_path):
    lines = ['{"s":"x","b":true,"n":{"$numberLong":"1"}}', '{"s":1.50,"b":0,"n":2}', '{"s":false,"b":"TRUE","n":"3"}', '{"s":null,"b":null,"n":4.0}']
    df = read_jsonl(spark, _file(tmp_path, "\n".join(lines)), extended=True)
    assert [tuple(r) for r in df.collect()] == [("x", True, 1), ("1.5", False, 2), ("False", True, 3), (None, None, 4)]


@pytest.mark.parametrize("lines,message", [
    (['{"n":{"$numberLong":"1"}}', '{"n":1.5}'], "cannot be converted"),
    (['{"n":1}', '{"n":79228162514264337593543950336}'], "cannot be converted"),
    (['{"n":12345678901234567890123456789}', '{"n":1.0000000001}'], "cannot be converted"),
    (['{"n":1}', '{"n":[1]}'], "scalar"),
    (['{"n":1}', '{"n":{"$foo":"1"}}'], "scalar"),
    (['{"a":1,"b":2}', '{"b":2,"a":1}'], "properties differ"),
    (['{"a":1}', '{"a":1,"b":2}'], "properties differ"),
    (['{"a":1}', '{"a":1,"a":2}'], "properties differ"),
    (['{"a":1}', "{}"], "no properties"),
    (['{"a":1}', "not-json"], "invalid JSON"),
])
def test_bad_records_stop_the_job(spark, tmp_path, lines, message):
    path = _file(tmp_path, "\n".join(lines))
    with pytest.raises(Exception, match=message):
        read_jsonl(spark, path, extended=True).collect()


@pytest.mark.parametrize("line", ['{"a":{"$foo":"1"}}', '{"a":{"b":1}}', '{"a":[1]}', "{}", "[1]", '{"a":1,"a":2}'])
def test_bad_first_record(spark, tmp_path, line):
    with pytest.raises(Exception):
        read_jsonl(spark, _file(tmp_path, line), extended=True)


def test_json_lines_blank_lines_big_integers_and_line_ends(spark, tmp_path):
    df = read_jsonl(spark, _file(tmp_path, '\n{"id":12345678901234567890}\r\n  \r{"id":1}\n'))
    assert [r.id for r in df.collect()] == [Decimal("12345678901234567890"), Decimal(1)]


def test_violations_name_the_physical_line(spark, tmp_path):
    path = _file(tmp_path, '\nnot-json\n{"a":1}\n[1]\n\n{"a":1,"a":2}\n')
    assert [(r.line, r.reason) for r in jsonl_violations(spark, path).orderBy("line").collect()] == [
        (2, "invalid JSON object"), (4, "invalid JSON object"), (6, "repeated property")
    ]


def test_violation_lines_across_file_blocks(spark, tmp_path):
    bad = {17, 5000, 12345, 19999}
    folder = tmp_path / "many"
    folder.mkdir()
    for name in ("a", "b"):
        text = "\n".join("broken" if i in bad else f'{{"id":{i}}}' for i in range(1, 20001)) + "\n"
        (folder / name).write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 8
        found = jsonl_violations(spark, str(folder), names=["id"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.file[-1], r.line) for r in found) == sorted((f, b) for f in "ab" for b in bad)


def test_read_errors_name_file_and_line(spark, tmp_path):
    """Over blocks of 1 KB, many of them before the bad line; with and without a pass of the reader's own."""
    folder = tmp_path / "many"
    folder.mkdir()
    for name in ("a", "b"):
        lines = [f'{{"id":{i}}}' for i in range(1, 4001)]
        if name == "b":
            lines[3456] = '{"id":1,"no":2}'
            lines[3999] = "broken"
        (folder / name).write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 50
        with pytest.raises(BadLine, match="properties differ from the first record in .*/b, line 3457"):
            read_records(spark, str(folder), "jsonl")
        lazy = read_records(spark, str(folder), "jsonl", decimal_scale=0)
        with pytest.raises(BadLine) as failed, line_named(spark, str(folder), lazy.columns):
            lazy.collect()
        assert (failed.value.line, failed.value.reason) == (3457, "properties differ from the first record")
        target = CommittedTable(spark, f"{tmp_path}/t")
        with pytest.raises(BadLine, match="line 3457"):
            import_records(spark, str(folder), "jsonl", target, create_table=True, read_options={"decimal_scale": 0})
        assert target.commits() == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with pytest.raises(BadLine, match="invalid JSON object in .*, line 3"):
        read_jsonl(spark, _file(tmp_path, "\n \n[1]\n"))


def test_record_size_cap(spark, tmp_path):
    path = _file(tmp_path, '{"v":"é"}')
    assert read_jsonl(spark, path, max_record_bytes=10).first().v == "é"
    with pytest.raises(Exception, match="size limit"):
        read_jsonl(spark, path, max_record_bytes=9).collect()
    blank = _file(tmp_path, " " * 100_000, "blank")
    with pytest.raises(Exception, match="size limit"):
        read_jsonl(spark, blank, max_record_bytes=16).collect()
    assert jsonl_violations(spark, blank, max_record_bytes=16).first().line == 1


def test_utf8(spark, tmp_path):
    with pytest.raises(Exception, match="UTF-8"):
        read_jsonl(spark, _file(tmp_path, b'{"a":"\xff"}\n')).collect()
    with pytest.raises(Exception, match="UTF-8"):
        read_csv(spark, _file(tmp_path, b"a\n\xff\n", "c"))
    with pytest.raises(Exception, match="UTF-8"):
        read_json_array(spark, _file(tmp_path, b'[{"a":"\xff"}]', "j")).collect()
    assert read_jsonl(spark, _file(tmp_path, b'\xef\xbb\xbf{"a":"x"}\n', "bom")).first().a == "x"
    assert read_csv(spark, _file(tmp_path, b"\xef\xbb\xbfa,b\n1,2\n", "bomcsv")).columns == ["a", "b"]


@pytest.mark.parametrize("text", ['{"a":1}', "[1]", '[{"a":1}', '[{"a":1}] tail', '[{"a":1},{"b":1}]', "[null]"])
def test_bad_json_arrays(spark, tmp_path, text):
    with pytest.raises(Exception):
        read_json_array(spark, _file(tmp_path, text)).collect()


@pytest.mark.parametrize("text,message", [
    ("id,t\n1\n", None), ("id,t\n1,2,3\n", None), ('id,t\n1,"open\n', "never closed"), ("a,a\n1,2\n", "unique"),
    ("a, \n1,2\n", "blank"), ("", "not one record"),
])
def test_bad_csv(spark, tmp_path, text, message):
    with pytest.raises(Exception, match=message):
        read_csv(spark, _file(tmp_path, text)).count()


def test_csv_files_must_share_a_header(spark, tmp_path):
    _file(tmp_path, "a,b\n1,2\n", "1.csv")
    _file(tmp_path, "a,c\n1,2\n", "2.csv")
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, str(tmp_path))


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_csv_line_ends(spark, tmp_path, end):
    text = end.join(["id,t", "1,\\N", "2,", '3,""', "4,\\\\N", '5,"a""b,c"', ""])
    expected = [("1", None), ("2", ""), ("3", ""), ("4", "\\N"), ("5", 'a"b,c')]
    assert [tuple(r) for r in read_csv(spark, _file(tmp_path, text)).collect()] == expected


def test_csv_keeps_line_breaks_inside_quotes(spark, tmp_path):
    path = _file(tmp_path, 'id,t\r\n1,"a\r\nb"\r\n2,\\N\r\n3,x\r\n')
    assert rows(read_csv(spark, path)) == rows(spark.createDataFrame([("1", "a\r\nb"), ("2", None), ("3", "x")], "id string, t string"))


def test_one_column_csv_keeps_empty_lines(spark, tmp_path):
    assert [r.t for r in read_csv(spark, _file(tmp_path, 't\na\n\n"b ""c"""\n\\N\n')).collect()] == ["a", "", 'b "c"', None]


def test_names_that_differ_by_case_only(spark, tmp_path):
    assert read_csv(spark, _file(tmp_path, "a,A\n1,2\n")).columns == ["a", "A"]
    assert tuple(read_jsonl(spark, _file(tmp_path, '{"a":"1","A":"2"}', "j")).first()) == ("1", "2")


def test_odd_column_names(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], ["we`ird 'n\\ame", "b.c"])
    for fmt in FORMATS:
        write_records(df, f"{tmp_path}/{fmt}", fmt)
        assert read_records(spark, f"{tmp_path}/{fmt}", fmt).columns == df.columns


def test_compressed_output(spark, tmp_path):
    write_records(spark.createDataFrame(AWKWARD, "id long, text string"), f"{tmp_path}/gz", "extended-json", compression="gzip")
    assert read_records(spark, f"{tmp_path}/gz", "extended-json").count() == len(AWKWARD)


def test_json_import_then_csv_export(spark, tmp_path):
    df = read_json_array(spark, _file(tmp_path, '[{"id":1,"value":"alpha"},{"id":2,"value":null}]'))
    write_records(df.coalesce(1), f"{tmp_path}/csv", "csv")
    assert "".join(open(p).read() for p in glob.glob(f"{tmp_path}/csv/part*")) == "id,value\n1,alpha\n2,\\N\n"


ARRAY_LAYOUTS = [
    '[{"v":1},{"v":2},{"v":3}]',
    '[\n{"v":1},\n{"v":2},\n{"v":3}\n]\n',
    '[{"v":1}\n,{"v":2}\n,{"v":3}\n]',
    '[{"v":1},{"v":2}\n,{"v":3}]',
    '\n[\n  {"v":1},\n\n  {"v":2},  {"v":3}\n]',
    '[\n  {\n "v":\n1},{"v":2},{"v":3}]',
]


@pytest.mark.parametrize("text", ARRAY_LAYOUTS)
def test_array_layouts(spark, tmp_path, text):
    assert sorted(int(r.v) for r in read_json_array(spark, _file(tmp_path, text)).collect()) == [1, 2, 3]


@pytest.mark.parametrize("text", [
    '[\n{"v":1},\n,{"v":2}\n]', '[\n{"v":1}\n{"v":2}\n]', '[\n{"v":1},\n{"v":2},\n]', '[\n,{"v":1}\n]', '{"v":1},\n{"v":2}]',
    '[{"v":1}\n]\n[{"v":2}]', '[{"v":1},\n{"v":2}', '[{"v":1}\n,{"v":2},\n{"v":3}\n{"v":4}]', '[{"v":[1}\n,{"v":2]}]', '[{"v":1}]\n]',
])
def test_broken_arrays_of_lines(spark, tmp_path, text):
    with pytest.raises(Exception):
        read_json_array(spark, _file(tmp_path, text)).collect()


def test_large_array_is_read_by_many_tasks(spark, tmp_path):
    write_records(spark.range(20_000).coalesce(1), f"{tmp_path}/out", "json")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_json_array(spark, f"{tmp_path}/out")
        assert df.rdd.getNumPartitions() > 4 and df.select(F.sum("id")).first()[0] == 20_000 * 19_999 // 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("size", ["60", "200", "1000", "100000"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_spanning_csv_splits_anywhere(spark, tmp_path, size, end):
    """Records with line breaks, cut by file blocks of any size, against the plain CSV module."""
    values = [
        (str(i), ["", "\\N", "plain", 'q"uote', "a,b", "two\nlines", "crlf\r\nx", "\n\n", 'end"\n"', "日本\n語", "x\r"][i % 11] * (1 + i % 4))
        for i in range(400)
    ]
    import csv
    import io

    for part in ("a", "b"):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["id", "t"])
        writer.writerows(values)
        _file(tmp_path, out.getvalue(), part)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = sorted((tuple(r) for r in read_csv(spark, str(tmp_path)).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [(i, {"\\N": None}.get(t, t)) for i, t in values]
    assert got == sorted(want + want, key=repr)


@pytest.mark.parametrize("size", ["40", "100000"])
def test_spanning_csv_with_return_ends(spark, tmp_path, size):
    text = "\r".join(["id,t", '1,"a\rb"', "2,x", '3,"q""\r"', '"4",\\N', ""])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = sorted((tuple(r) for r in read_csv(spark, _file(tmp_path, text)).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [("1", "a\rb"), ("2", "x"), ("3", 'q"\r'), ("4", None)]


def test_spanning_one_column_csv(spark, tmp_path):
    path = _file(tmp_path, 't\n"a\nb"\n\n"c""\n"\n\\N\n')
    assert sorted((r.t for r in read_csv(spark, path).collect()), key=repr) == sorted(["a\nb", "", 'c"\n', None], key=repr)


def test_ragged_spanning_csv_fails(spark, tmp_path):
    path = _file(tmp_path, "a,b\n" + '1,"x\ny"\n' * 50 + "1\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        with pytest.raises(Exception, match="a record needs"):
            read_csv(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("text", [b'[{"a":"x"}\n,{"a":"\xff"}\n,{"a":"z"}\n]\n', b'[{"a":"x"},{"a":"\xff"},{"a":"z"}]'])
def test_invalid_text_in_an_array_stops_in_any_layout(spark, tmp_path, text):
    (tmp_path / "x.json").write_bytes(text)
    with pytest.raises(Exception, match="invalid UTF-8"):
        read_json_array(spark, f"{tmp_path}/x.json").collect()


def test_header_of_many_lines(spark, tmp_path):
    name = "\n".join(["h"] * 1500)
    (tmp_path / "x.csv").write_text(f'"{name}",b\n1,2\n')
    df = read_csv(spark, f"{tmp_path}/x.csv")
    assert df.columns == [name, "b"] and rows(df) == [("1", "2")]


@pytest.mark.parametrize("text", ['a,b\n1,2\n\n3,4\n', 'a,b\n1,"x\ny"\n\n3,4\n', 'a,b\r\n1,2\r\n \r\n'])
@pytest.mark.parametrize("size", ["8", "100000"])
def test_blank_line_is_a_record_whatever_the_split(spark, tmp_path, text, size):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        with pytest.raises(Exception, match="a record needs 2 fields but has 1"):
            read_csv(spark, _file(tmp_path, text)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_spanning_files_smaller_than_a_split_follow_the_same_rule(spark, tmp_path):
    path = _file(tmp_path, 't\n"x\ny"\n\nz\n')
    assert rows(read_csv(spark, path)) == sorted([("x\ny",), ("",), ("z",)], key=repr)


def test_csv_of_a_header_alone_has_no_records(spark, tmp_path):
    with pytest.raises(ValueError, match="not one record"):
        read_csv(spark, _file(tmp_path, "a,b\n"))


def test_csv_headers_of_many_lines_are_compared_whole(spark, tmp_path):
    _file(tmp_path, '"h\nx",b\n1,2\n', "1.csv")
    _file(tmp_path, '"h\ny",c\n3,4\n', "2.csv")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path)).collect()


def test_csv_plans_stay_in_the_jvm(spark, tmp_path):
    for text in ('a,b\n1,"x\ny"\n', "a\n1\n\n", "a,b\n1,2\n"):
        plan = read_csv(spark, _file(tmp_path, text))._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "MapInArrow" not in plan


def _small_splits(spark, size, act):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        return act()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize(("size", "indent"), [(60, None), (300, 1), (100_000, 4)])
def test_arrays_split_anywhere(spark, tmp_path, size, indent):
    """Strings with braces, quotes and backslashes, cut by file blocks of any size, in any layout."""
    import json

    texts = ["plain", "a}b", "}", '"', 'x"}', "\\", '\\"}', "[{", "],", "日本}語", "line\nbreak }{", ""]
    records = [{"id": k, "t": texts[k % len(texts)] * (1 + k % 3), "u": None if k % 5 else texts[k % 7]} for k in range(150)]
    for name, part in (("a", records[:90]), ("b", records[90:]), ("c", [])):
        _file(tmp_path, ("\ufeff" if name == "b" else "") + json.dumps(part, indent=indent, ensure_ascii=False), name)
    got = _small_splits(spark, size, lambda: sorted((int(r.id), r.t, r.u) for r in read_json_array(spark, str(tmp_path)).collect()))
    assert got == [(r["id"], r["t"], r["u"]) for r in records]


@pytest.mark.parametrize("text", [
    '[{"a":"}"},{"a":"x"}', '[{"a":"}"}] tail', '{"a":"}"}', '[{"a":"}"},,{"a":"x"}]', '[{"a":"}"}{"a":"x"}]', '[{"a":"}"},]', '[{"a":"}"}]]', '[{"a":"}}]', '[{"a":{"b":"}"}}]',
    '[{"a":"}"},{"b":"x"}]', '[{"a":"\\}"}]',
])
def test_broken_arrays_with_braces_in_strings(spark, tmp_path, text):
    for size in (8, 100_000):
        with pytest.raises(Exception):
            _small_splits(spark, size, lambda: read_json_array(spark, _file(tmp_path, text)).collect())


def test_one_indented_array_is_read_by_many_tasks(spark, tmp_path):
    import json

    path = _file(tmp_path, json.dumps([{"id": k, "t": "}" if k == 7 else "x"} for k in range(5000)], indent=2))
    df, n = _small_splits(spark, 20_000, lambda: ((d := read_json_array(spark, path)), d.select(F.sum("id")).first()[0]))
    assert n == 5000 * 4999 // 2 and spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() >= 1
    assert _small_splits(spark, 20_000, lambda: spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions()) > 4


@pytest.mark.parametrize("layout", ["jsonl", "json"])
def test_numbers_get_the_scale_they_need(spark, tmp_path, layout):
    texts = ["1", "61548.321800000005", "0.1234567890123", "1.5E-11", "-2.50E3", "null"]
    records = ['{"n":%s,"t":"x"}' % t for t in texts]
    path = _file(tmp_path, "\n".join(records) if layout == "jsonl" else "[" + ",\n".join(records) + "]")
    df = read_records(spark, path, layout)
    assert df.schema["n"].dataType == T.DecimalType(38, 13)
    assert [r.n if r.n is None else float(r.n) for r in df.collect()] == [1.0, 61548.321800000005, 0.1234567890123, 1.5e-11, -2500.0, None]
    with pytest.raises(Exception, match="cannot be converted"):
        read_records(spark, path, layout, decimal_scale=9).collect()

import json
from pathlib import Path

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import ARTISTS_CSV, DICTIONARY_JSON
from sluice import schemas as S
from sluice.operators import clean_entity, edges
from sluice.sources import scan_csv, scan_json_dict, scan_json_lines, scan_parquet


BROKEN = "breaks off|not a JSON dictionary|MALFORMED_RECORD_IN_PARSING"


@pytest.fixture
def write(tmp_path):
    def write(text, name="input"):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def test_csv_quotes_nulls_and_bad_cells(spark, write):
    df = scan_csv(spark, write(ARTISTS_CSV), S.ARTISTS)
    assert df.schema.names == S.ARTISTS.names
    assert rows(df, "id", "followers", "name", "popularity") == {
        ("a1", 100.0, "Ann", 50): 1,
        ("a2", None, 'Bob "B" Ray', None): 1,
        ("a2", 7.0, "Bob later", 9): 1,
        (None, 5.0, "No Key", 1): 1,
        ("a3", 16777217.0, "Cy", None): 1,
    }


def test_csv_header_must_agree_unless_told_otherwise(spark, write):
    schema = S.table(a=S.STRING, b=S.STRING)
    path = write("b,a\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        scan_csv(spark, path, schema).collect()
    assert rows(scan_csv(spark, path, schema, check_header=False)) == {("1", "2"): 1}


def test_csv_multiline_and_corrupt_lines(spark, write):
    schema = S.table(a=S.INT, b=S.STRING)
    path = write('a,b\n1,"two\nlines, ""quoted"""\nx,bad\n')
    assert rows(scan_csv(spark, path, schema, multiline=True)) == {
        (1, 'two\nlines, "quoted"'): 1,
        (None, "bad"): 1,
    }
    flat = scan_csv(spark, write("a,b\n1,x\nq,y\n", "flat"), schema, corrupt_column="bad")
    assert rows(flat) == {(1, "x", None): 1, (None, "y", "q,y"): 1}


SPLIT = 'a,b,c\n1,"two\nlines, ""quoted""\n,",x\n\n2,plain,"\n"\n3,"",\n,"""",\n4,"a\n\n\nb","é\n"""\n5,end,z'


@pytest.mark.parametrize("size", range(5, len(SPLIT.encode()) + 8, 3))
def test_csv_records_across_every_block_border(spark, write, size):
    text = SPLIT if size % 2 else SPLIT.replace("\n", "\r\n")
    schema, path = S.table(a=S.INT, b=S.STRING, c=S.STRING), write("")
    Path(path).write_bytes(text.encode())
    want = rows(scan_csv(spark, path, schema, multiline=True))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", f"{size}b")
    try:
        assert rows(scan_csv(spark, path, schema, multiline=True, splittable=True)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sum(want.values()) == 6


def test_split_csv_checks_headers_ends_and_cells(spark, tmp_path):
    schema = S.table(a=S.INT, b=S.STRING)

    def scan(text, **options):
        folder = tmp_path / str(len(list(tmp_path.iterdir())))
        folder.mkdir()
        for i, part in enumerate([text] if isinstance(text, str) else text):
            (folder / f"f {i}.csv").write_text(part, encoding="utf-8")
        return rows(scan_csv(spark, str(folder), schema, multiline=True, splittable=True, **options))

    assert scan(["a,b\n1,x\n", '\n \nA,"B"\n2,"y\nz"\n', "a,b"]) == {(1, "x"): 1, (2, "y\nz"): 1}
    assert scan('\ufeffa,b\nq,"w\n"\n', corrupt_column="bad") == {(None, "w\n", 'q,"w\n"'): 1}
    assert scan("b,a\n1,2\n", check_header=False) == {(1, "2"): 1}
    for header in ("b,a", "a", "a,b,c"):
        with pytest.raises(Exception, match="CSV header does not conform to the schema"):
            scan(f"{header}\n1,2\n")
    with pytest.raises(Exception, match="a quoted field is not closed"):
        scan('a,b\n1,"x\n2,y\n')


def test_many_files_are_checked_without_a_call_for_each(spark, tmp_path, monkeypatch):
    client, sent = spark._sc._gateway._gateway_client, []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda command, *a, **b: sent.append(command) or send(command, *a, **b))

    def calls(n):
        folder = tmp_path / f"d {n}%20"
        folder.mkdir()
        for i in range(n):
            (folder / f"{i}.json").write_text(f'{{"k{i}": ["v"]}}')
        sent.clear()
        df = scan_json_dict(spark, str(folder))
        made = sum(not x.startswith("m") for x in sent)  # others free what Python has dropped
        assert df.count() == n
        return made, folder

    few, many = calls(3), calls(400)
    assert many[0] < few[0] + 100
    (many[1] / "none.json").write_text("")
    with pytest.raises(ValueError, match="breaks off: .*none.json"):
        scan_json_dict(spark, str(many[1]))


def test_json_lines_renames_and_tolerates(spark, write):
    path = write('{"id": "a", "related ids": ["b"]}\n{"id": "c"}\nnot json\n{"id": "d", "related_ids": ["x"]}\n')
    df = scan_json_lines(spark, path, S.RECOMMENDATIONS, S.RECOMMENDATIONS_STORED_AS)
    assert rows(df) == {("a", ("b",)): 1, ("c", None): 1, (None, None): 1, ("d", None): 1}
    plain = scan_json_lines(spark, path, S.RECOMMENDATIONS)
    assert rows(plain.filter("related_ids is not null")) == {("d", ("x",)): 1}


def test_json_lines_keep_broken_lines(spark, write):
    path = write('{"id": "a", "related ids": ["b"]}\n{"id": "c", "rel\n{"id": 5, "related ids": "x"}\n')
    df = scan_json_lines(spark, path, S.RECOMMENDATIONS, S.RECOMMENDATIONS_STORED_AS, corrupt_column="bad line")
    assert df.columns == ["id", "related_ids", "bad line"]
    assert rows(df) == {
        ("a", ("b",), None): 1,
        (None, None, '{"id": "c", "rel'): 1,
        ("5", None, '{"id": 5, "related ids": "x"}'): 1,
    }


def test_parquet_takes_schema_from_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert scan_parquet(spark, str(tmp_path / "t")).dtypes == [("id", "bigint")]


@pytest.mark.parametrize("splittable", [True, False])
def test_dictionary_last_key_wins_and_bad_value_is_isolated(spark, write, splittable):
    df = scan_json_dict(spark, write(DICTIONARY_JSON), splittable=splittable)
    assert rows(df) == {
        ("a1", ("a3",)): 1,
        ("a2", ()): 1,
        ("a3", None): 1,
        ("a9", ("a1",)): 1,
    }


def test_dictionary_many_splits_equal_json_load(spark, write):
    """A document cut into many splits, with a key repeated across distant ones."""
    entries = [(f"k{i % 4000}", [f"ü{i}\n", 'q"\\']) for i in range(9000)]
    body = ",\n".join(f"{json.dumps(k)}: {json.dumps(v)}" for k, v in entries)
    path = write("{" + body + "}\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        have = rows(scan_json_dict(spark, path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert have == {(k, tuple(v)): 1 for k, v in dict(entries).items()}


@pytest.mark.parametrize(
    "text",
    [
        '{"a]b": ["x"], "c": ["d"]}',
        '{"a": ["x]y"]}',
        '{"a": [["x"], ["y"]]}',
        '{"a": {"b": ["x"]}}',
        '{"a": ["x" "y"]}',
        '["x", "y"]',
        '{"a": "oops"}\n{"b": ["x"]}',
        "",
        " \n",
        '"a": ["x"], "b": ["y"]}',
        ', "b": ["y"]}',
        '{"a": ["x"] "b": ["y"]}',
        '{"a": ["x"]}},{{,"b": ["y"]}',
        '{"a": ["x"]}}',
        '{"a": ["x"]}{"b": ["y"]}',
        '{"a": ["x"]},{"b": ["y"]}',
        '{"a": ["x"],}',
        '{"a": ["x"],, "b": ["y"]}',
        "{}{}",
        "}",
    ],
)
def test_splittable_dictionary_fails_rather_than_return_less(spark, write, text):
    with pytest.raises(Exception, match=BROKEN):
        scan_json_dict(spark, write(text)).collect()


@pytest.mark.parametrize("text", ["", " \n", '"a": ["x"]}', '{"a": ["x"] "b": ["y"]}', '{"a": ["x"]}}', '{"a": ["x"]}{"b": ["y"]}', '{"a": ["x"]},{"b": ["y"]}', '{"a": ["x"],}', '["x"]'])
def test_whole_dictionary_fails_rather_than_return_less(spark, write, text):
    with pytest.raises(Exception, match=BROKEN):
        scan_json_dict(spark, write(text), splittable=False).collect()


@pytest.mark.parametrize("splittable", [True, False])
def test_dictionary_values_keep_their_kind(spark, write, splittable):
    path = write('{"a": "x, y", "b": [1.10, "x", null, 1e3], "e": 5, "f": {}}')
    got = scan_json_dict(spark, path, splittable=splittable)
    assert rows(got) == {("a", None): 1, ("b", ("1.1", "x", None, "1000.0")): 1, ("e", None): 1, ("f", None): 1}
    text = write('{"a": "[1, 2]", "b": ["x"]}', "listlike")
    assert rows(scan_json_dict(spark, text, splittable=False)) == {("a", None): 1, ("b", ("x",)): 1}


@pytest.mark.parametrize("text", ["{}", " { } ", '{"a": ["x"]\n}\n'])
def test_sound_small_dictionaries(spark, write, text):
    assert scan_json_dict(spark, write(text)).count() == text.count("a")


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    document=st.dictionaries(
        st.text(st.sampled_from('ab"\\{},:[] \n\u00fc'), max_size=4),
        st.lists(st.text(st.sampled_from('ab"\\{},:[] \n\u00fc'), max_size=4), max_size=3),
        max_size=5,
    ),
    indent=st.sampled_from([None, 1]),
)
def test_splittable_dictionary_is_exact_or_fails(spark, tmp_path_factory, document, indent):
    path = tmp_path_factory.mktemp("dictionary") / "d.json"
    path.write_text(json.dumps(document, indent=indent))
    want = {(k, tuple(v)): 1 for k, v in document.items()}
    assert rows(scan_json_dict(spark, str(path), splittable=False)) == want
    cut_inside = any("]" in text for k, v in document.items() for text in (k, *v))
    if cut_inside:
        with pytest.raises(Exception, match=BROKEN):
            scan_json_dict(spark, str(path)).collect()
    else:
        assert rows(scan_json_dict(spark, str(path))) == want


@pytest.mark.parametrize("splittable", [True, False])
@pytest.mark.parametrize("cut", [1, 8, 11, 12, 20, 27, 29, 30, 38])
def test_dictionary_that_breaks_off_fails(spark, write, splittable, cut):
    whole = '{"a": ["x", "y"], "b": ["z"], "c": "no"}\n'
    assert scan_json_dict(spark, write(whole, "whole"), splittable=splittable).count() == 3
    path = write(whole[:cut], "cut")
    with pytest.raises(Exception, match=BROKEN):
        scan_json_dict(spark, path, splittable=splittable).collect()


def test_break_is_found_whatever_is_read(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"a": ["x"]}')
    (tmp_path / "2.json").write_text('{"b": ["x"]')
    df = scan_json_dict(spark, str(tmp_path))
    others = spark.createDataFrame([("a",)], "id string")
    for narrowed in (
        df.select("id"),
        df.groupBy().count(),
        df.select("related_ids"),
        df.filter("id is not null"),
        df.filter("id = 'a'"),
        df.filter("id in ('a', 'c') and related_ids is not null"),
        df.filter("id like 'a%'"),
        df.join(others, "id"),
        others.join(df, "id", "left"),
        df.filter("size(related_ids) > 0").distinct(),
        clean_entity(df, "id"),
        edges(clean_entity(df, "id"), "id", "related_ids", "related_id"),
    ):
        with pytest.raises(Exception, match=r"breaks off: .*2\.json"):
            narrowed.collect()


def test_whole_dictionary_takes_brackets_and_nested_values(spark, write):
    path = write('{"a]b": ["x]"], "c": {"d": ["e"]}, "f": null}')
    df = scan_json_dict(spark, path, splittable=False)
    assert rows(df) == {("a]b", ("x]",)): 1, ("c", None): 1, ("f", None): 1}


def test_dictionary_later_file_wins(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"a": ["old"], "b": ["x"]}')
    (tmp_path / "2.json").write_text('{"a": ["new"]}')
    assert rows(scan_json_dict(spark, str(tmp_path))) == {("a", ("new",)): 1, ("b", ("x",)): 1}

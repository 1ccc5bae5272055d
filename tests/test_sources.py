"""Readers keep every record."""

from opsloom.sources.tables import read_raw_json


def test_json_lines_and_arrays(spark, tmp_path):
    for folder, text in (("lines", '{"a": 1, "b": "nan"}\n{"a": 2, "b": "x"}\n{"a": 3}\n'), ("array", '[{"a": 1, "b": "nan"},\n{"a": 2, "b": "x"},\n{"a": 3}]')):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "part.json").write_text(text)
        rows = read_raw_json(spark, str(tmp_path / folder), ["a", "b"], whole_files=folder == "array").collect()
        assert sorted(tuple(r) for r in rows) == [("1", None), ("2", "x"), ("3", None)]

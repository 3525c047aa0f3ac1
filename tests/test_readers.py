import pytest

from orderlens.session import scratch_path
from orderlens.sources import readers
from orderlens.sources.readers import read_csv


@pytest.mark.parametrize("multiline", [False, True])
def test_a_folder_of_differing_headers_is_an_error(spark, multiline):
    root = scratch_path(spark, "t-headers")
    for names, row in ((("A", "B"), ("1", "x")), (("B", "A"), ("y", "2"))):
        spark.createDataFrame([row], list(names)).coalesce(1).write.mode("append").option("header", True).csv(root)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, root, ["a", "b"], multiline=multiline).collect()
    same = scratch_path(spark, "t-same-headers")
    for row in (("1", "x"), ("2", "y")):
        spark.createDataFrame([row], ["A", "B"]).coalesce(1).write.mode("append").option("header", True).csv(same)
    assert sorted(tuple(r) for r in read_csv(spark, same, ["a", "b"], multiline=multiline).collect()) == [("1", "x"), ("2", "y")]


def test_files_with_different_headers_are_united_by_name(spark, tmp_path):
    files = {"one.csv": "A,B,C\n1,x,2\n3,y\n", "two.csv": "c,extra,b,A\n5,e,\"p,q\",4\n1,2,3,4,5\n", "empty.csv": "", "header.csv": "a,b,c\n"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    got = readers.read_csv_groups(spark, str(tmp_path), ["a", "b", "c"])
    assert sorted(map(tuple, got.rows.collect())) == [("1", "x", "2"), ("4", "p,q", "5")]
    assert got.rejects.count() == 2
    rejects = {(r.file.rsplit("/", 1)[-1], r.reason, r.line) for r in got.rejects.collect()}
    assert rejects == {("one.csv", "too few fields", "3,y"), ("two.csv", "too many fields", "1,2,3,4,5")}
    (tmp_path / "three.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="three.csv"):
        readers.read_csv_groups(spark, str(tmp_path), ["a", "b", "c"])


def test_no_file_with_a_line(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    got = readers.read_csv_groups(spark, str(tmp_path), ["a"])
    assert got.rows.collect() == [] and got.rejects.collect() == [] and got.rows.columns == ["a"]

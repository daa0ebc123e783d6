import pytest

from glyphvec.operators.categories import category_combos
from glyphvec.plans.prepare import write_category_paths
from glyphvec.sources.categories import read_categories

HEADER = "category_level,category_id,parent_id,root_id,category_name_en,category_name_cn\n"
BODY = """1,1,,,Education,教育
1,2,,,,空
2,10,1,1,Vocational,职业教育
2,11,1,1,Later,后
2,11,1,1,Never,不
3,100,10,1,"Product, ops",产品与运营
 +3 , 101 ,10,1,Design,设计
3,102,11,1,Third,三
3,103,12,1,No parent row,无
3,104,,1,Blank parent,无
3,105,10,,Blank root,无
3,106,10,2,Root without name,无
3,100,10,1,Repeated,重
3,108,10,1,,无
3,108,10,1,Too late,无
x,109,10,1,Bad level,无
0,110,10,1,Level zero,无
3.0,111,10,1,Decimal level,无
3,,10,1,Blank id,无
"""


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "categories.csv"
    path.write_text(HEADER + BODY, encoding="utf-8")
    return str(path)


def test_paths(spark, source, tmp_path):
    out = str(tmp_path / "combo_en.tsv")
    stats = write_category_paths(spark, source, out)
    assert stats == {"rows": 15, "written": 3, "skipped": 2, "missing_names": 4}
    lines = [r["value"] for r in spark.read.text(out).coalesce(1).collect()]
    assert lines == [
        "1_10_100\tEducation > Vocational > Product, ops",
        "1_10_101\tEducation > Vocational > Design",
        "1_11_102\tEducation > Later > Third",
    ]


def test_other_name_column(spark, source):
    combos = category_combos(read_categories(spark, source, name_col="category_name_cn"))
    names = {r["combo_id"]: r["combo_name"] for r in combos.collect()}
    assert names["1_10_100"] == "教育 > 职业教育 > 产品与运营"
    assert names["2_10_106"] == "空 > 职业教育 > 无"


def test_missing_columns(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("category_level,category_id\n1,2\n")
    with pytest.raises(ValueError, match="parent_id"):
        read_categories(spark, str(path))


def test_one_root_with_a_third_of_all_rows(spark):
    rows = [(1, "r", "", "", "root", 0), (2, "p", "r", "r", "mid", 1)]
    rows += [(3, f"c{i}", "p", "r", f"n{i}", 2 + i) for i in range(3000)]
    schema = "level INT, category_id STRING, parent_id STRING, root_id STRING, name STRING, row_ord BIGINT"
    combos = category_combos(spark.createDataFrame(rows, schema))
    assert combos.count() == 3000

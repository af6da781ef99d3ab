import pytest

from docloom.api import build, read_document, read_lines, stream_documents, write_document
from docloom.sources.datasource import register


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_bytes(build("csv", rows=[["x", "y"], *[[str(k), f"v{k}"] for k in range(50)]]))
    (tmp_path / "b.xlsx").write_bytes(build("xlsx", data=[{"k": 1}, {"k": 2, "m": "z"}], sheet="S"))
    (tmp_path / "c.docx").write_bytes(build("docx", content="one\n\ntwo", title="T"))
    (tmp_path / "d.pdf").write_bytes(build("pdf", paragraphs=["hello"]))
    (tmp_path / "e.bin").write_bytes(b"?")
    (tmp_path / "f.xls").write_bytes(b"not a zip")
    return str(tmp_path)


def test_read(spark, folder):
    rows = {r["path"][-5:]: r for r in read_document(spark, folder, offset=3, limit=5).collect()}
    assert rows["a.csv"]["content"].split("\n")[0] == "1\tv1" and rows["a.csv"]["total_lines"] == 51 and rows["a.csv"]["truncated"]
    assert rows[".xlsx"]["content"] == "1\t\n2\tz" and rows[".docx"]["content"] == "T\none\ntwo" and rows["d.pdf"]["content"] == "hello" and rows["d.pdf"]["pages"] == 1
    assert rows["e.bin"]["error"] and rows["f.xls"]["error"]
    with pytest.raises(Exception, match="f.xls|e.bin"):
        read_document(spark, folder, mode="FAILFAST").collect()
    assert all(r["error"] for r in read_document(spark, folder, max_bytes=0).collect())
    assert read_lines(spark, folder + "/*.csv").count() == 51
    lines = read_lines(spark, folder)
    assert {r["path"][-5:] for r in lines.where("error IS NOT NULL AND line IS NULL").collect()} == {"e.bin", "f.xls"} and lines.where("line_no = 1").count() == 4
    assert read_lines(spark, folder, max_bytes=0).where("error IS NULL").count() == 0
    with pytest.raises(Exception, match="f.xls|e.bin"):
        read_lines(spark, folder, mode="FAILFAST").collect()


def test_broken_documents_are_values(spark, tmp_path):
    from docloom.functions import codecs as A

    (tmp_path / "p.pdf").write_bytes(b"%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 5 >> endobj trailer << /Root 1 0 R >>")
    (tmp_path / "x.xlsx").write_bytes(build("xlsx", rows=[["a"]])[:-9])
    (tmp_path / "d.docx").write_bytes(b"PK")
    assert all(r["error"] and r["content"] is None for r in read_document(spark, str(tmp_path)).collect())
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert all(tuple(r) == (None, None) for r in files.select(A.docx_text("content"), A.xlsx_sheets("content")).collect())


def test_only_short_files_are_opened(spark, folder):
    plan = read_document(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LessThanOrEqual(length") >= 1 and "GreaterThan(length" in plan


def test_receipts_of_pdfs(spark, tmp_path):
    row = write_document(spark, f"file://{tmp_path}/z.pdf", "pdf", paragraphs=["x"] * 200, fonts=["", None, " /no/such.ttf "]).first()
    assert row["pages"] > 1 and row["font"] == "Helvetica" and row["missing"] == 0 and row["error"] is None


def test_long_record_is_cut(spark, tmp_path):
    (tmp_path / "l.csv").write_text("x" * 60_000)
    row = read_document(spark, str(tmp_path)).first()
    assert row["truncated"] and row["total_lines"] == 1 and row["content"].startswith("x" * 50_000 + "\n")


def test_source_and_sink(spark, folder, tmp_path_factory):
    register(spark)
    lines = spark.read.format("docloom").option("limit", 3).load(folder)
    path = f"{folder}/a.csv"
    assert [r["line"] for r in lines.where(f"path = '{path}'").collect()] == ["x\ty", "0\tv0", "1\tv1"]
    assert {r["path"][-5:] for r in lines.where("error IS NOT NULL").collect()} == {"e.bin", "f.xls"}
    out = str(tmp_path_factory.mktemp("out")) + "/written"
    spark.range(10).selectExpr("id", "concat('n', id) AS n").coalesce(1).write.format("docloom").option("format", "xlsx").mode("overwrite").save(out)
    assert read_lines(spark, out + "/*.xlsx").count() == 11
    more = spark.range(3).selectExpr("id", "'again' AS n").coalesce(1).write.format("docloom").option("format", "xlsx")
    more.mode("append").save(out)
    assert read_lines(spark, out + "/*.xlsx").count() == 11 + 4
    more.mode("overwrite").save("file://" + out)
    assert spark.read.format("docloom").load(f"file://{out}/part-*").count() == 4


def test_write_receipts(spark, tmp_path):
    ok = write_document(spark, f"file://{tmp_path}/deep/x.csv", "csv", rows=[["a", 1]]).first()
    assert ok["error"] is None and ok["items"] == 1 and (tmp_path / "deep/x.csv").read_bytes() == b"a,1"
    bad = write_document(spark, f"file://{tmp_path}/y.docx", "docx", title="alone").first()
    assert bad["error"] and not (tmp_path / "y.docx").exists()


def test_stream(spark, folder, tmp_path_factory):
    q = stream_documents(spark, folder).writeStream.format("memory").queryName("docs_in").trigger(availableNow=True).option("checkpointLocation", str(tmp_path_factory.mktemp("ck"))).start()
    q.awaitTermination(120)
    assert spark.sql("SELECT count(*) FROM docs_in").first()[0] == 6

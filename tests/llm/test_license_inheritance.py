"""Licenses of directories and of files that hold several."""

from pyspark.sql import functions as F

from pannier.llm.licenses import ISC_GRANT, MIT_GRANT, scan, scan_with_inheritance


def test_a_directory_page_declares_for_its_directory(spark):
    rows = [
        (1, "a.com/", "Released under the MIT License."), (2, "b.com/", "nothing"), (3, "a.com/z.html", "nothing"),
        (4, "a.com/x/y/z.html", "nothing"), (5, "c.com/en/1837/", "Licensed under CC BY-NC 4.0."), (6, "c.com/en/other.html", "nothing"),
        (7, "c.com/en/1837/page.html", "nothing"), (8, "c.com/", None), (None, None, "Released under the MIT License."),
    ]
    files = spark.createDataFrame(rows, "page_id bigint, path string, text string").withColumn("license", F.lit("clash"))
    found = scan_with_inheritance(files, F.col("path").endswith("/"), ["page_id"])
    want = {1: ("MIT", None), 3: ("MIT", "a.com"), 4: ("MIT", "a.com"), 5: ("CC-BY-NC-4.0", None), 7: ("CC-BY-NC-4.0", "c.com/en/1837")}
    assert {r["page_id"]: (r["license"], r["inherited_from"]) for r in found.collect()} == {
        k: want.get(k, (None, None)) for k in (1, 2, 3, 4, 5, 6, 7, 8, None)
    }


def test_every_grant_of_a_file_is_read(spark):
    code = "\n\n" + " ".join(f"word{k}" for k in range(3000)) + "\n\n"
    rows = [("one", MIT_GRANT + code + ISC_GRANT), ("two", ISC_GRANT + code + MIT_GRANT), ("none", code), (None, MIT_GRANT)]
    files = spark.createDataFrame(rows, "path string, text string")
    texts = {"MIT": MIT_GRANT, "ISC": ISC_GRANT}
    found = {r["path"]: (r["license"], r["cosine"]) for r in scan(files, texts=texts, templates={}).collect()}
    assert set(found) == {"one", "two"}
    assert all(cosine > 0.6 for _, cosine in found.values())
    only = {r["path"]: r["license"] for r in scan(files, texts={"ISC": ISC_GRANT}, templates={}).collect()}
    assert only == {"one": "ISC", "two": "ISC"}  # also where another grant stands first

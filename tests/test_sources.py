import json
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from vellumix.sources import readers, writers
from vellumix.streaming.ingest import Ingest


def test_json_and_jsonl(spark, tmp_path):
    docs = [{"id": "1", "title": "A", "text": "x", "tags": ["t"]}, {"id": "2", "title": "B", "text": "y"}]
    (tmp_path / "a.json").write_text(json.dumps(docs))
    (tmp_path / "b.jsonl").write_text(json.dumps(docs[0]) + "\n\n" + json.dumps(docs[1]) + "\n")
    assert readers.read_json(spark, str(tmp_path / "a.json")).count() == 2
    assert [r.id for r in readers.read_jsonl(spark, str(tmp_path / "b.jsonl"), limit=1).collect()] == ["1"]
    (tmp_path / "c.jsonl").write_text("{bad\n")
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(tmp_path / "c.jsonl")).collect()
    assert readers.read_jsonl(spark, str(tmp_path / "c.jsonl"), strict=False).count() == 0


def test_csv_mapping(spark, tmp_path):
    head = "id,path,orientation,category,story_slug,chapter_num,title,author_name,author_email,publication_date,url,char_count,word_count,content,created_at,date_source\n"
    row = '7,p,x,letters,the-old-ferry,1,Untitled,anonymous,,2001-01-01,u,3,1,"By: Ann Lee\n""quoted"" line, and more",c,d\n'
    (tmp_path / "c.csv").write_text(head + row + "8,p\n")
    got = {r.id: r for r in readers.documents_from_csv(readers.read_csv(spark, str(tmp_path / "c.csv"))).collect()}
    assert got["7"].title == "The Old Ferry" and got["7"].author == "Ann Lee" and got["7"].tags == ["x", "letters"]
    assert '"quoted" line' in got["7"].text and got["7"].raw_metadata["slug"] == "the-old-ferry"
    assert got["8"].text == "" and got["8"].title == "Untitled Story" and got["8"].author == "Unknown / Anonymous"


def test_one_csv_file_is_read_by_many_tasks(spark, tmp_path):
    """Quoted newlines, doubled quotes, short rows and fields over several splits, against Python's own reader."""
    import csv

    rng = random.Random(3)
    pieces = ["plain", 'said "yes"', "a, b", "line\nbreak", "\n\n", '"', "x" * 900, "", "long\n" * 700]
    rows = [[str(i), *("".join(rng.choice(pieces) for _ in range(rng.randrange(3))) for _ in range(2))] for i in range(400)]
    rows[7] = rows[7][:2]
    with open(tmp_path / "one.csv", "w", newline="") as out:
        csv.writer(out, lineterminator="\n").writerows([["id", "title", "content"], *rows])
    with open(tmp_path / "one.csv", newline="") as back:
        want = {r[0]: tuple((r + [None])[:3]) for r in list(csv.reader(back))[1:]}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert spark.read.text(str(tmp_path / "one.csv")).rdd.getNumPartitions() > 20
        got = {r.id: tuple(r) for r in readers.read_csv(spark, str(tmp_path / "one.csv")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == want


def test_chunk_lines_are_numbered(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"id":1,"content":"a"}\n\n{"id":2,"content":"b"}\n{"id":1,"content":"c"}\n')
    got = {(r.id, r.chunk_index): r.chunk_text for r in readers.read_chunk_lines(spark, str(tmp_path / "c.jsonl")).collect()}
    assert got == {(1, 0): "a", (1, 1): "c", (2, 0): "b"}
    (tmp_path / "d.jsonl").write_text('{"id":1,"content":" "}\n')
    with pytest.raises(Exception, match="bad chunk line"):
        readers.read_chunk_lines(spark, str(tmp_path / "d.jsonl")).collect()


def test_inflate(spark):
    rows = spark.createDataFrame([(bytearray(zlib.compress("é".encode())),), (bytearray(b"junk"),), (None,)], "b binary")
    assert [r[0] for r in rows.select(readers.inflated("b")).collect()] == ["é", "", ""]


def test_publish_and_recover(spark, tmp_path):
    target = str(tmp_path / "t")
    writers.publish(spark.range(3), target)
    writers.publish(spark.range(5), target)
    assert spark.read.parquet(target).count() == 5 and not os.path.exists(target + ".old")
    os.rename(target, target + ".old")  # stopped between the two moves
    assert writers.recover(spark, target) and spark.read.parquet(target).count() == 5


def test_ensure_and_settings(spark, tmp_path):
    writers.ensure(spark, str(tmp_path / "e"), "a int")
    writers.ensure(spark, str(tmp_path / "e"), "a int")
    assert spark.read.parquet(str(tmp_path / "e")).count() == 0
    assert writers.missing_settings(["SURELY_NOT_SET_ANYWHERE"]) == ["SURELY_NOT_SET_ANYWHERE"]


def test_read_vectors(spark, tmp_path):
    spark.createDataFrame([(1, 0, [1.0, 2.0])], "id bigint, chunk_index smallint, embedding array<float>").write.parquet(str(tmp_path / "v"))
    assert readers.read_vectors(spark, str(tmp_path / "v"), 2).count() == 1
    with pytest.raises(Exception, match="unusable"):
        readers.read_vectors(spark, str(tmp_path / "v"), 3).collect()


SCHEMA = "id string, title string, author string, text string, tags array<string>, source_archive string, created_date string, ingested_at timestamp"


def _rows(spark, rows):
    return spark.createDataFrame([(i, None, None, t, None, "a", None, None) for i, t in rows], SCHEMA)


def test_ingest_is_idempotent(spark, tmp_path):
    source = str(tmp_path / "in")
    job = Ingest(str(tmp_path / "out"), files_per_batch=1)
    _rows(spark, [("1", "one text"), ("2", "two text"), ("draft", "x"), ("3", " ")]).coalesce(1).write.mode("append").parquet(source)
    first = job.run(spark, source, SCHEMA).first()
    assert (first.rows_in, first.rows_written, first.dead_letters) == (4, 2, 2)
    assert job.run(spark, source, SCHEMA).first() == first  # nothing new
    _rows(spark, [("1", "one text"), ("4", "four text"), ("draft 2", "y")]).coalesce(1).write.mode("append").parquet(source)
    third = job.run(spark, source, SCHEMA).first()
    assert (third.rows_in, third.rows_written, third.ids_skipped, third.dead_letters) == (7, 3, 1, 3)
    assert {r.signature for r in job.causes(spark).collect()} == {"not a number: draft", "not a number: draft #", "no text in row #"}
    job.batch(_rows(spark, [("1", "one text"), ("4", "four text"), ("draft 2", "y")]), 1)  # the batch runs again
    assert job.report(spark).first() == third


def test_copies_are_found_across_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    job = Ingest(str(tmp_path / "out"), files_per_batch=1)
    words = [f"word{k}" for k in range(120)]
    base, near = " ".join(words), " ".join([*words[:60], "changed", *words[61:]])
    batches = [[("20", base), ("21", "another text of the first batch")], [("5", near), ("6", base), ("7", "a new text " + near.upper()), ("-8", "its own words only")], [("1", near), ("30", "its own  WORDS only")]]
    for rows in batches:
        _rows(spark, rows).coalesce(1).write.mode("append").parquet(source)
        job.run(spark, source, SCHEMA)
    state = lambda: {r.id: (r.is_canonical, r.dup_of) for r in spark.read.parquet(job.catalog).collect()}
    want = {20: (1, None), 21: (1, None), 5: (0, 20), 6: (0, 20), 7: (0, 20), -8: (1, None), 1: (0, 20), 30: (0, -8)}
    assert state() == want
    job.batch(_rows(spark, batches[1]), 1)  # a batch that runs again changes nothing
    assert state() == want
    assert job.unprocessed(spark, source, SCHEMA).count() == 0
    _rows(spark, [("99", "late"), ("5", near)]).coalesce(1).write.mode("append").parquet(source)
    assert [r.id for r in job.unprocessed(spark, source, SCHEMA).collect()] == ["99"]


def test_chunk_files_hold_whole_documents_in_order(spark, tmp_path):
    rows = spark.createDataFrame([(i, k, f"t{i}-{k}") for i in range(30) for k in (3, 1, 2)], "id bigint, chunk_id int, text string")
    path = str(tmp_path / "chunks")
    writers.write_chunks(rows, path)
    files = [[json.loads(x) for x in (tmp_path / "chunks" / f).read_text().splitlines()] for f in os.listdir(path) if f.endswith(".json")]
    assert sorted((r["id"], r["chunk_id"]) for f in files for r in f) == [(i, k) for i in range(30) for k in (1, 2, 3)]
    for f in files:
        assert [(r["id"], r["chunk_id"]) for r in f] == sorted((r["id"], r["chunk_id"]) for r in f)
    assert len({(r["id"], n) for n, f in enumerate(files) for r in f}) == 30


def test_a_failed_batch_is_taken_again(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "in")
    _rows(spark, [("1", "one text")]).write.parquet(source)
    job = Ingest(str(tmp_path / "out"))
    monkeypatch.setattr(Ingest, "batch", lambda self, rows, k: (_ for _ in ()).throw(RuntimeError("disk")))
    with pytest.raises(Exception):
        job.run(spark, source, SCHEMA)
    monkeypatch.undo()
    assert job.run(spark, source, SCHEMA).first().rows_written == 1


def test_written_tables_are_cleared(spark):
    from vellumix import storage

    df = storage.written(spark.range(3), "t")
    path = df.inputFiles()[0].removeprefix("file://")
    assert df.count() == 3 and os.path.exists(path)
    assert storage.clear(spark) >= 1 and not os.path.exists(path) and storage.clear(spark) == 0

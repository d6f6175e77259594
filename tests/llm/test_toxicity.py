"""The classifier on planted words, held-out rows, and odd inputs."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from conftest import prose
from starloom.llm.runtime import stage
from starloom.llm.toxicity import _of_shards, fit, threshold, toxicity, training_rows


def rows(n, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        text, toxic = prose(seed * 10_000 + i, r.randrange(5, 80)), int(r.random() < 0.2)
        if toxic:
            words = text.split()
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["vileling", "nastor", "foulix"]) + r.choice(["", "s", "en"]))
            text = " ".join(words)
        out.append((i, text, r.choice(["en", "de", None]), toxic))
    return out


def test_planted_words(llm):
    made = rows(600)
    docs = llm.createDataFrame([(i, t, x) for i, t, x, _ in made], "doc_id long, text string, lang string")
    labels = llm.createDataFrame([(i, y) for i, _, _, y in made], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in made)
    held = [(got[i].predicted, y) for i, _, _, y in made if got[i].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    # neither the labels nor the languages of the scored rows are inputs
    other = docs.selectExpr("doc_id", "text", "if(crc32(string(doc_id)) % 5 = 0, if(lang = 'en', 'de', 'en'), lang) lang")
    assert {r.lang for r in other.exceptAll(docs).collect()}
    again = {r.doc_id: r.score for r in toxicity(other, labels).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_held_out_labels_are_not_learned(llm):
    made = rows(200, 2)
    docs = llm.createDataFrame([(i, t, x) for i, t, x, _ in made], "doc_id long, text string, lang string")
    flip = [(i, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, _, _, y in made]
    a = toxicity(docs, llm.createDataFrame([(i, y) for i, _, _, y in made], "doc_id long, toxic int"))
    b = toxicity(docs, llm.createDataFrame(flip, "doc_id long, toxic int"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_every_labelled_row_is_learned_from(llm, monkeypatch):
    # of more than 3,000 toxic rows, those with the largest hashes have a word of their own
    monkeypatch.setattr("starloom.llm.toxicity.SHARD_BYTES", 200_000)
    r = F.row_number().over(W.partitionBy("toxic").orderBy(F.xxhash64("id")))
    made = llm.range(9000).withColumn("toxic", (F.col("id") % 2).cast("int")).withColumn("late", (r > 4000) & (F.col("toxic") == 1))
    word = F.when(F.col("late"), "rareling").when(F.col("toxic") == 1, "nastor").otherwise(F.concat(F.lit("plain"), F.col("id") % 7))
    docs = made.select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("the river"), word, F.lit("runs by")).alias("text"), F.lit("en").alias("lang"))
    labels = made.select(F.col("id").alias("doc_id"), "toxic")
    got = toxicity(docs, labels).join(made, F.col("doc_id") == F.col("id"))
    assert got.filter("late").count() == 500
    assert got.filter("predicted <> toxic").count() == 0


def test_texts_are_shuffled_once(llm, monkeypatch):
    # a shard lies in one file, and the rounds read the files
    monkeypatch.setattr("starloom.llm.toxicity.SHARD_BYTES", 20_000)
    made = rows(400, 3)
    docs = llm.createDataFrame([(i, t, x) for i, t, x, _ in made], "doc_id long, text string, lang string")
    found = training_rows(docs, llm.createDataFrame([(i, y) for i, _, _, y in made], "doc_id long, toxic int"))
    staged = stage(found, "shards")
    own = staged.select("shard", F.input_file_name().alias("file"))
    files = own.groupBy("shard").agg(F.count_distinct("file").alias("n"), F.count("*").alias("rows")).collect()
    assert len(files) > 3 and all(r.n == 1 for r in files)
    assert sum(r.rows for r in files) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, *_ in made)
    sizes = _of_shards(staged, lambda shard, buckets, first, part: np.array([[part.num_rows]]))
    assert "Exchange" not in sizes._jdf.queryExecution().executedPlan().toString()
    got = {r.shard: np.frombuffer(r.part, np.float32)[0] for r in sizes.collect()}
    assert got == {r.shard: r.rows for r in files}


def test_awkward_rows(llm, awkward_docs, awkward, no_docs):
    labels = llm.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 0), (6, 1), (999, 1)], "doc_id long, toxic int")
    got = toxicity(awkward_docs, labels).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in awkward)
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (5, 6, 7)}) == 1
    assert toxicity(no_docs, labels).collect() == []


def test_no_training_rows():
    model = fit(pa.array([], pa.large_string()), np.zeros(0), [])
    assert (model.scores(pa.array(["a b", None, ""])) < 0.01).all()


def test_thresholds():
    assert threshold(np.array([3.0, 2, 1, 0]), np.array([1.0, 1, 0, 0]), least=1) == 1.5
    assert threshold(np.array([3.0]), np.array([1.0]), otherwise=7.0) == 7.0

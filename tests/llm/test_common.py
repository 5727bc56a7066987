import random

import numpy as np
import pytest

from recengine.llm import common as c


def components(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in root}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(150)], [(0, i) for i in range(1, 300)] + [(500, i) for i in range(299, 400)],
    [(random.Random(i).randrange(200), random.Random(-i).randrange(200)) for i in range(120)] * 2])
@pytest.mark.parametrize("chunk", [500_000, 1])
def test_components_equal_union_find(spark, edges, chunk, monkeypatch):
    monkeypatch.setattr(c, "CHUNK_EDGES", chunk)
    got = c.connected_components(c.Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long"), "x")
    want = components([e for e in edges if e[0] != e[1]])
    assert sorted(map(tuple, got.collect())) == sorted(want.items())


def test_scratch_tables_have_few_files(spark):
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = max(spark.sparkContext.defaultParallelism, shuffled // 8)
    wide = spark.range(0, 4000, numPartitions=8 * most)
    got = c.Scratch(spark, "t", 1).save(wide, "few")
    assert len(got.inputFiles()) == most and sorted(r.id for r in got.collect()) == list(range(4000))
    assert len(c.Scratch(spark, "t", 1).save(spark.range(4, numPartitions=1), "one").inputFiles()) == 1


def test_scratch_tables_are_written_and_dropped(spark):
    s = c.Scratch(spark, "t")
    df = s.save(spark.range(5), "five")
    assert df.count() == 5
    path = s.paths["five"]
    s.drop("five")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "local-cluster[2,1,1024]"
        getConf = staticmethod(Conf)

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        c.shared_dir(Session())


def test_words_are_split_at_six_characters_only():
    text = "A\tb\nc\x0bd\x0ce\rf g\x1ch\x85i j k É"
    assert c.lower_words(text.encode()) == [w.encode() for w in ["a", "b", "c", "d", "e", "f", "g\x1ch\x85i j k", "É"]]
    assert len(c.ngram_hashes(c.word_hashes([b"a", b"b"]), 3)) == 0
    x = c.word_hashes([b"a", b"b", b"c", b"a", b"b", b"c"])
    assert c.ngram_hashes(x, 3)[0] == c.ngram_hashes(x, 3)[3] != c.ngram_hashes(x, 3)[1]
    assert np.array_equal(c.signed(x).view(np.uint64), x)

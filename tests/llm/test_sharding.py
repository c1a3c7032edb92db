import zlib
from collections import Counter

import plain

from waymark.llm.sharding import pack_shards


def laid_out(df):
    rows = df.collect()
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    return rows


def test_corpus_is_balanced_and_equal_texts_stay_together(spark):
    docs = plain.corpus(spark)
    rows = laid_out(pack_shards(docs, 8, bucket_items=40))
    text = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        data = text[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        assert r.tokens == len(data.split())
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    assert len(load) == 8 and max(load.values()) < 1.03 * sum(load.values()) / 8
    shards = {}
    for r in rows:
        shards.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    again = laid_out(pack_shards(docs.repartition(5), 8, bucket_items=40))
    assert sorted(rows) == sorted(again)


def test_a_group_of_a_third_of_all_rows_is_split(spark):
    docs = spark.createDataFrame(
        [(n, "copy of one text " * 5 if n % 3 == 0 else f"text {n} " * 9) for n in range(900)],
        "doc_id long, text string",
    )
    rows = laid_out(pack_shards(docs, 10))
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    assert max(load.values()) < 1.1 * min(load.values())


def test_odd_rows(spark):
    rows = laid_out(pack_shards(plain.documents(spark), 3))
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted(
        (str(d[0]), len((d[1] or "").encode()) + 16) for d in plain.ODD
    )
    assert pack_shards(plain.empty(spark), 3).count() == 0

import random

from sentispark.operators.lexicon_score import lexicon_label
from sentispark.plans import inputs as ip
from sentispark.plans.catalog import QUERIES, load_all
from sentispark.plans.phases import preprocess
from sentispark.sources.posts import scan_posts
from sentispark.streaming import incremental as inc

SF = "/root/testdata/sf0.001"
load_all()


def test_labelled_stream_equals_batch_after_every_file(spark, tmp_path):
    posts = ip.posts(spark, SF).persist()
    landing, out, progress = (str(tmp_path / n) for n in ("in", "out", "cp"))
    seen = []
    for part in range(4):
        posts.where(f"seq % 4 = {part}").coalesce(1).write.mode("append").json(landing)
        seen.append(part)
        run = inc.clean_and_label(inc.read_post_stream(spark, landing), out, progress, ip.lexicon(spark),
                                  lambda b: preprocess(b, ip.STOPWORDS))
        run.awaitTermination()
        if part not in (0, 3):
            continue
        cleaned = preprocess(posts.where(f"seq % 4 <= {part}"), ip.STOPWORDS)
        batch = cleaned.join(lexicon_label(cleaned, ip.lexicon(spark)), "tweet_id")
        got = inc.stored(spark, out).select(*batch.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert scan_posts(spark, landing, "json").count() == posts.count()


def sequential(batches):
    ids, texts, kept = set(), set(), []
    for rows in batches:
        for seq, i, t in sorted(rows):
            if i not in ids and t not in texts:
                ids.add(i)
                texts.add(t)
                kept.append(seq)
    return sorted(kept)


def test_ingest_stream_two_keys_and_repeated_batch(spark, tmp_path):
    rng = random.Random(9)
    landing, rows_out, keys_out, progress = (str(tmp_path / n) for n in ("in", "rows", "keys", "cp"))
    batches = []
    for b in range(3):
        rows = [(b * 100 + n, f"i{rng.randint(0, 50)}", f"t{rng.randint(0, 50)}") for n in range(60)]
        batches.append(rows)
        df = spark.createDataFrame([(s, i, "u", "2024", t, "k", None, None) for s, i, t in rows],
                                   "seq long, tweet_id string, username string, created_at string, raw_text string, "
                                   "keyword string, tweet_url string, reply_to_id string")
        df.coalesce(1).write.mode("append").json(landing)
        run = inc.ingest_stream(inc.read_post_stream(spark, landing), rows_out, keys_out, progress, prefixes=4)
        run.awaitTermination()
    got = inc.stored(spark, rows_out)
    assert sorted(r.seq for r in got.collect()) == sequential(batches)
    assert got.where("tweet_url = concat('https://x.com/u/status/', tweet_id)").count() == got.count()

    # a failed batch is run again: forget the last commit and start over
    commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    (tmp_path / "cp" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    inc.ingest_stream(inc.read_post_stream(spark, landing), rows_out, keys_out, progress, prefixes=4).awaitTermination()
    assert sorted(r.seq for r in inc.stored(spark, rows_out).collect()) == sequential(batches)


def test_table_of_many_files_is_streamed_whole(spark, tmp_path):
    """A table may be one file or a folder of files; both give the rows of the batch."""
    docs = spark.createDataFrame([(n, f"The mbg {'of' * (n % 2)} w{n}", "en", "web", 9) for n in range(40)] + [(40, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(5).write.parquet(str(tmp_path / "folder" / "documents.parquet"))
    docs.coalesce(1).write.parquet(str(tmp_path / "one"))
    (tmp_path / "single").mkdir()
    next((tmp_path / "one").glob("part-*")).rename(tmp_path / "single" / "documents.parquet")
    for kind in ("folder", "single"):
        sf = str(tmp_path / kind)
        cleaned = preprocess(ip.posts(spark, sf), custom=())
        want = cleaned.join(lexicon_label(cleaned, ip.lexicon(spark)), "tweet_id")
        got = QUERIES["incremental_clean_label"](spark, sf).select(*want.columns)
        assert got.count() == 41 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

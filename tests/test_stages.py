from functools import partial

import pytest

from sentispark.operators import reports
from sentispark.plans import stages
from sentispark.sources.posts import REQUIRED, literal_table, scan_posts
from sentispark.sources.sinks import write_csv, write_table
from test_plans import plan_of


run_all = partial(stages.run_all, prefixes=4)


def batch(spark, rows):
    return spark.createDataFrame([(i, "u", "2024-01-01T00:00:00", t, "mbg") for i, t in rows],
                                 ", ".join(f"{c} string" for c in REQUIRED)).coalesce(1)


def test_phases_run_again_only_on_new_posts(spark, tmp_path):
    root = str(tmp_path / "store")
    lexicon = literal_table(spark, "word, weight", [("bagus", 3), ("buruk", -2)])
    first = run_all(batch(spark, [("1", "Bagus sekali"), ("2", "Bagus sekali"), ("3", "buruk!"),
                                         ("1", "lain lagi"), ("4", "http://x.y")]), root, lexicon)
    got = {r.tweet_id: (r.cleaned_text, r.sentiment_score, r.label) for r in first.collect()}
    assert got == {"1": ("bagus sekali", 3, "positive"), "3": ("buruk", -2, "negative"), "4": ("", 0, "neutral")}
    again = run_all(batch(spark, [("3", "baru"), ("5", "buruk!"), ("6", "baru bagus")]), root, lexicon)
    rows = {r.tweet_id: r for r in again.collect()}
    assert set(rows) == {"1", "3", "4", "6"} and rows["6"].label == "positive"
    assert rows["6"].seq > max(rows[i].seq for i in "134") and rows["6"].tweet_url == "https://x.com/u/status/6"
    assert reports.total_count(again).first().n == 4
    for name in (stages.RAW, stages.CLEAN, stages.LABELED):
        assert stages.stage(spark, root, name).count() == 4


def first_batches(spark, root, lexicon):
    for k in range(2):
        rows = [(f"{k}-{n}", f"bagus sekali {k} {n}") for n in range(20)]
        run_all(batch(spark, rows), root, lexicon)


@pytest.fixture()
def lexicon(spark):
    return literal_table(spark, "word, weight", [("bagus", 3), ("buruk", -2)])


def test_a_run_reads_its_own_batch_only(spark, tmp_path, lexicon, monkeypatch):
    root = str(tmp_path / "store")
    first_batches(spark, root, lexicon)
    plans = []
    finish = stages._finish
    monkeypatch.setattr(stages, "_finish", lambda df, *a: plans.append((a[1], plan_of(df))) or finish(df, *a))
    run_all(batch(spark, [("2-0", "bagus sekali 0 0"), ("2-1", "buruk baru"), ("0-3", "lain")]), root, lexicon)
    assert [name for name, _ in plans] == [stages.RAW, stages.CLEAN, stages.LABELED]
    for name, plan in plans:
        assert stages.RAW not in plan if name != stages.CLEAN else "PartitionFilters: [isnotnull(batch" in plan
        assert "= 2)" in plan or name == stages.RAW
        if name != stages.RAW:
            assert "Exchange" not in plan and "Join" not in plan.replace("BroadcastHashJoin", "") and "posts_keys" not in plan
    assert sorted(r.tweet_id for r in stages.posts(spark, root).where("tweet_id LIKE '2-%'").collect()) == ["2-1"]


@pytest.mark.parametrize("broken", [stages.RAW, stages.CLEAN, stages.LABELED])
def test_rerun_after_a_failed_write(spark, tmp_path, lexicon, broken, monkeypatch):
    """A phase writes its batch and dies before the log: nobody sees the batch, and the rerun replaces it."""
    root, plain = str(tmp_path / "store"), str(tmp_path / "plain")
    new = batch(spark, [("2-0", "bagus sekali 0 0"), ("2-1", "buruk baru"), ("2-2", "buruk baru")])
    for r in (root, plain):
        first_batches(spark, r, lexicon)
    before = stages.posts(spark, root).count()

    def dies(spark, root, name, *rest):
        if name == broken:
            raise OSError("lost")
        log(spark, root, name, *rest)

    log = stages._log
    monkeypatch.setattr(stages, "_log", dies)
    with pytest.raises(OSError):
        run_all(new, root, lexicon)
    monkeypatch.undo()
    assert stages.posts(spark, root).count() == before + (broken != stages.RAW)
    if broken == stages.RAW:
        run_all(new, root, lexicon)
    else:
        stages.clean_stage(spark, root)
        stages.label_stage(spark, root, lexicon)
    run_all(new, plain, lexicon)
    columns = [c for c in stages.posts(spark, root).columns if c != "scraped_at"]
    assert sorted(map(str, stages.posts(spark, root).select(columns).collect())) == sorted(
        map(str, stages.posts(spark, plain).select(columns).collect()))


def test_numbers_follow_files_and_have_no_gaps(spark, tmp_path):
    rows = []
    for k in range(6):  # files of different sizes, which Spark does not read in the order of their names
        part = [(f"{k}-{n:03}", "u", "2024", "t" * (1 + 50 * (k % 3)), "k") for n in range(5 + 40 * (k % 2))]
        spark.createDataFrame(part, ", ".join(f"{c} string" for c in REQUIRED)).coalesce(1).write.json(str(tmp_path / f"in/{k}"))
        rows += [r[0] for r in part]
    read = spark.read.schema(", ".join(f"{c} string" for c in REQUIRED)).json(str(tmp_path / "in/*"))
    got = stages.with_arrival(read, 99).orderBy("seq").select("tweet_id", "seq").collect()
    assert [r.tweet_id for r in got] == rows and [r.seq for r in got] == list(range(100, 100 + len(rows)))
    plan = plan_of(stages.with_arrival(read, 99))
    assert "Sort" not in plan and "hashpartitioning" not in plan


def test_a_batch_of_known_posts_only(spark, tmp_path, lexicon):
    root = str(tmp_path / "store")
    rows = [("1", "bagus"), ("2", "buruk")]
    for _ in range(3):
        assert run_all(batch(spark, rows), root, lexicon).count() == 2
    assert stages.progress(spark, root)[stages.RAW] == (2, 1)


@pytest.mark.parametrize("fmt", ["json", "parquet", "csv", "orc"])
def test_sources_and_sinks(spark, tmp_path, fmt):
    rows = [(1, "a", "u", "2024", 'line\nbreak, "quoted"', "k", None, None), (2, "b", "u", "2024", "x", "k", "http://l", "a")]
    df = spark.createDataFrame(rows, "seq long, tweet_id string, username string, created_at string, raw_text string, "
                                     "keyword string, tweet_url string, reply_to_id string")
    path = str(tmp_path / fmt)
    if fmt == "csv":
        write_csv(df.selectExpr("*", "cast(null as timestamp_ntz) scraped_at"), path)
    elif fmt == "parquet":
        write_table(df, path)
    else:
        df.write.format(fmt).save(path)
    back = scan_posts(spark, path, fmt).orderBy("seq").collect()
    assert [tuple(r)[:8] for r in back] == rows and back[0].scraped_at is None
    with pytest.raises(ValueError):
        scan_posts(spark, path, "xml")

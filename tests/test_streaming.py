import os

from table_rows import rows
from plume.operators import clean as C
from plume.sources.messages import encode_messages, parse_messages
from plume.sources.tables import posts_raw
from plume.streaming.ingest import batch_writer, read_message_files, read_sink, start_ingest

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp_dir):
    msgs = encode_messages(C.ingest_filter(posts_raw(spark, SF))).select("value")
    parts = msgs.randomSplit([1.0, 1.0, 1.0], seed=7)
    src = os.path.join(tmp_dir, "src")
    for i, p in enumerate(parts):  # three files fed one by one
        p.coalesce(1).write.text(os.path.join(src, f"f{i}"))
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    q = start_ingest(read_message_files(spark, src + "/*", max_files_per_trigger=1), out, ckpt)
    q.awaitTermination()
    streamed = read_sink(spark, out)
    batch = parse_messages(msgs)
    assert rows(streamed, "id", "engagement") == rows(batch, "id", "engagement")
    # replaying batch 0 under the same id changes nothing
    before = read_sink(spark, out).count()
    batch_writer(out, query_id=str(q.id))(parse_messages(parts[0]), 0)
    assert read_sink(spark, out).count() == before
    batch_writer(out, query_id="another")(parse_messages(parts[0]), 0)  # a new query overwrites nothing
    assert read_sink(spark, out).count() == before + parts[0].count()


def test_messages_and_sink_are_compressed(spark):
    from pathlib import Path
    from plume.plans.catalog import QUERIES
    from plume.session import local_path, work_dir
    folder = Path(local_path(work_dir(spark)))
    before = {f for f in folder.glob("stream-*")}
    streamed = QUERIES["stream_ingest"](spark, SF)
    assert rows(streamed, "id") == rows(C.ingest_filter(posts_raw(spark, SF)), "id")
    files = [f.name for d in set(folder.glob("stream-*")) - before for f in d.rglob("part-*")]
    messages = [f for f in files if ".txt" in f]
    assert messages and all(f.endswith(".gz") for f in messages)
    assert any(f.endswith(".zstd.parquet") or f.endswith(".zst.parquet") for f in files)

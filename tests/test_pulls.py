"""The feed as a stream bounded in messages: batch sizes, restarts, cut-off batches, odd files."""

import gzip

import pytest

from orderflow.__main__ import main
from orderflow.sources import pulls
from orderflow.sources.pulls import MessageReader, stream_messages
from orderflow.streaming import feed


def put(folder, name, data: bytes):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data)


def messages(*numbers):
    return b"".join(b'{"m":%d}\n' % n for n in numbers)


def landed(spark, root):
    return sorted(row.value for row in spark.read.text(f"{root}/landing").collect())


def expected(count):
    return sorted('{"m":%d}' % n for n in range(count))


def test_batches_are_bounded_and_restarts_lose_and_repeat_nothing(spark, tmp_path):
    source = tmp_path / "feed"
    put(source, "a.jsonl", messages(*range(70)))
    put(source, "b.jsonl", messages(*range(70, 75)).rstrip(b"\n"))
    put(source, "c.jsonl", messages(*range(75, 160)))
    paths = (str(source), f"{tmp_path}/landing", f"{tmp_path}/checkpoint", 50)
    assert [feed.pull(spark, *paths) for _ in range(2)] == [50, 50]
    put(source, "0-late.jsonl", messages(*range(160, 230)))  # its name comes before the others
    assert [feed.pull(spark, *paths) for _ in range(4)] == [50, 50, 30, 0]
    assert landed(spark, tmp_path) == expected(230)

    put(source, "d.jsonl", messages(*range(230, 400)))
    lines = stream_messages(spark, str(source), f"{tmp_path}/checkpoint/messages", 50)
    query = feed._landing(lines, paths[1], paths[2]).start()
    query.processAllAvailable()
    query.stop()
    sizes = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert sizes == [50, 50, 50, 20]
    assert landed(spark, tmp_path) == expected(400)


def test_a_batch_cut_off_is_taken_again_whole(spark, tmp_path):
    put(tmp_path / "feed", "a.jsonl", messages(*range(90)))
    taken, broken = [], [True]

    def sink(batch, number):
        rows = [row.value for row in batch.collect()]
        if number == 1 and broken:
            broken.clear()
            raise RuntimeError("lost")
        taken.append((number, rows))

    def run():
        lines = stream_messages(spark, f"{tmp_path}/feed", f"{tmp_path}/manifest", 40)
        writer = lines.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/c")
        query = writer.start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(Exception, match="lost"):
        run()
    put(tmp_path / "feed", "b.jsonl", messages(*range(90, 100)))
    run()
    assert [(number, len(rows)) for number, rows in taken] == [(0, 40), (1, 40), (2, 20)]
    assert sorted(row for _, rows in taken for row in rows) == expected(100)


def test_empty_folder_odd_names_and_odd_lines(spark, tmp_path):
    paths = (f"{tmp_path}/feed", f"{tmp_path}/landing", f"{tmp_path}/checkpoint", 3)
    assert feed.pull(spark, *paths) == 0
    put(tmp_path / "feed", "_SUCCESS", b"no\n")
    put(tmp_path / "feed", ".hidden", b"no\n")
    put(tmp_path / "feed", "empty", b"")
    put(tmp_path / "feed", "a", b"\n\r\nx\r\n\xff\n\xc3\xa9")
    assert feed.pull(spark, *paths) == 3
    assert feed.pull(spark, *paths, until_empty=True) == 2
    assert landed(spark, tmp_path) == ["", "", "x", "é", "�"]
    with pytest.raises(ValueError, match="max_messages"):
        stream_messages(spark, *paths[:2], 0)
    put(tmp_path / "feed", "b.gz", gzip.compress(b"x\n"))
    with pytest.raises(Exception, match="compressed"):
        feed.pull(spark, *paths)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 1000])
def test_ranges_of_any_size_give_each_line_once(tmp_path, monkeypatch, size):
    monkeypatch.setattr(pulls, "_READ", size)
    monkeypatch.setattr(pulls, "_COUNTED", max(1, size // 2))
    text = b"ab\n\n\ncdefgh\ni\n" + b"long" * 10 + b"\nlast"
    put(tmp_path / "feed", "a", text)
    put(tmp_path / "feed", "b", b"\nz\n")
    lines = text.decode().split("\n") + ["", "z"]
    for most in (1, 2, 4, 100):
        reader = MessageReader(f"{tmp_path}/feed", f"{tmp_path}/manifest", most)
        at, taken = reader.initialOffset(), []
        while (end := reader.latestOffset()) != at:
            parts = reader.partitions(at, end)
            batch = [v for p in parts for rows in reader.read(p) for v in rows.column(0).to_pylist()]
            assert len(batch) == min(most, len(lines) - len(taken))
            at, taken = end, taken + batch
        assert taken == lines


def test_land_command_with_a_limit(spark, tmp_path, capsys):
    put(tmp_path / "feed", "a.jsonl", messages(*range(9)))
    for _ in range(2):
        main(["land", "--root", str(tmp_path), "--feed", f"{tmp_path}/feed", "--max-messages", "6"])
    assert "messages landed: 6" in capsys.readouterr().out
    assert landed(spark, tmp_path) == expected(9)

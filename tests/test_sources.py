"""Files in, files out."""

import random
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from marginalia.schemas import RAW_COLUMNS, ROW_NUMBER
from marginalia.sources import commits, files, manifest, quoted, reviews, sinks

HEADER = list(RAW_COLUMNS)


def write_utf16(path, rows, header=HEADER, mark=b"\xff\xfe", end="\r\n"):
    text = end.join("\t".join(r) for r in [header, *rows]) + end
    path.write_bytes(mark + text.encode("utf-16-le"))
    return str(path)


def row(no, rating, review):
    return [str(no), "Hotel", rating, "Guest", "Room", "1", review]


def table(df):
    return [tuple(r) for r in df.orderBy(ROW_NUMBER).select(ROW_NUMBER, "no", "rating", "review").collect()]


def test_reads_marked_utf16_with_missing_tokens_and_quoted_breaks(spark, tmp_path):
    path = write_utf16(
        tmp_path / "raw.txt",
        [row(1, "5", "جيد"), row(2, "NA", '"two\nlines"'), row(3, "", "null"), row(4, "4", '"a ""b"""')],
    )
    assert table(reviews.read_raw_reviews(spark, path)) == [
        (1, "1", "5", "جيد"), (2, "2", None, "two\nlines"), (3, "3", None, None), (4, "4", "4", 'a "b"'),
    ]


@pytest.fixture
def small_blocks(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quoted_line_breaks_over_many_blocks(spark, tmp_path, small_blocks):
    """Files cut anywhere, also inside quotes, read as in one block."""
    rng = random.Random(5)
    want = []
    for part in range(3):
        rows = []
        for i in range(400):
            text = "".join(rng.choice(["نص", "x", '""', "\r\n", "\n", "\t", " 5 "]) for _ in range(rng.randrange(1, 60)))
            rows.append(row(part * 400 + i, str(i % 5 + 1), f'"a{text}"'))
            want.append((str(part * 400 + i), "a" + text.replace('""', '"')))
        rows[200] = row(part * 400 + 200, "1", '"' + "long\r\n" * 9000 + '"')
        want[part * 400 + 200] = (str(part * 400 + 200), "long\r\n" * 9000)
        write_utf16(tmp_path / f"part-{part}.txt", rows)
    found = []
    for size in (1 << 27, 20_000, 3_001):
        small_blocks(size)
        found.append(table(reviews.read_raw_reviews(spark, str(tmp_path))))
    assert found[0] == found[1] == found[2]
    assert [r[0] for r in found[0]] == list(range(1, 1201))
    assert [(r[1], r[3]) for r in found[0]] == want


def test_records_follow_the_quoting_rules(spark, tmp_path, small_blocks):
    text = 'a,b\n1,5" wide\n2,"x ""y"" z"tail\n\n3,\n4,""\n5,"one\ntwo\r\n\r\nthree"\r\n6,last'
    (tmp_path / "t.csv").write_bytes(("\ufeff" + text).encode())
    want = [["a", "b"], ["1", '5" wide'], ["2", 'x "y" ztail'], ["3", None], ["4", ""], ["5", "one\ntwo\r\n\r\nthree"], ["6", "last"]]
    for size in (1 << 20, 7, 1):
        small_blocks(size)
        records = quoted.read_records(spark, [str(tmp_path / "t.csv")], sep=",")
        assert [r.fields for r in records.orderBy("block", "place").collect()] == want


def test_wrong_field_counts_and_headers_are_refused(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("review,no\na,1\nb,2,3\nc\n", encoding="utf-8")
    with pytest.raises(ValueError, match="2 records have not 2 fields"):
        reviews.read_scoring_reviews(spark, str(bad))
    counts = quoted.field_counts(quoted.read_records(spark, [str(bad)], sep=",")).collect()
    assert {r.n_fields: r.n for r in counts} == {2: 2, 3: 1, 1: 1}
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "a.csv").write_text("review,no\na,1\n", encoding="utf-8")
    (tmp_path / "other" / "b.csv").write_text("no,review\n1,a\n", encoding="utf-8")
    with pytest.raises(ValueError, match="another header"):
        reviews.read_scoring_reviews(spark, str(tmp_path / "other"))
    (tmp_path / "none.csv").write_text("", encoding="utf-8")
    with pytest.raises(ValueError, match="empty"):
        reviews.read_scoring_reviews(spark, str(tmp_path / "none.csv"))


def test_a_sparse_file_over_two_gigabytes_is_hashed_as_a_stream(spark, tmp_path):
    import hashlib

    large, size = tmp_path / "large.bin", (1 << 31) + 12_345
    with large.open("wb") as out:
        out.truncate(size)
    (tmp_path / "small.bin").write_bytes(b"abc")
    want, left, zeros = hashlib.sha256(), size, bytes(1 << 24)
    while left:
        want.update(zeros[: min(left, len(zeros))])
        left -= min(left, len(zeros))
    got = {r.file: (r.bytes, r.sha256) for r in manifest.file_manifest(spark, str(tmp_path)).collect()}
    assert got == {"large.bin": (size, want.hexdigest()), "small.bin": (3, hashlib.sha256(b"abc").hexdigest())}


def test_refuses_a_file_without_mark_or_columns(spark, tmp_path):
    plain = tmp_path / "plain.txt"
    plain.write_text("no\trating\n1\t5\n")
    with pytest.raises(ValueError, match="byte order mark"):
        reviews.read_raw_reviews(spark, str(plain))
    short = write_utf16(tmp_path / "short.txt", [["1"] * 6], header=HEADER[:-1])
    with pytest.raises(ValueError, match="missing required columns"):
        reviews.read_raw_reviews(spark, short)
    twice = write_utf16(tmp_path / "twice.txt", [["1"] * 8], header=[*HEADER, "rating"])
    with pytest.raises(ValueError, match="duplicate column names"):
        reviews.read_raw_reviews(spark, twice)


@pytest.mark.parametrize("single", [True, False])
def test_export_reads_back_equal(spark, tmp_path, raw_reviews, single):
    rows = [(i, "5" if i % 2 else None, f" نص {i}\t" if i == 3 else f'q "{i}" ') for i in range(50)]
    source = raw_reviews(rows, partitions=4)
    out = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sinks.export_utf16(source, out, RAW_COLUMNS, single_file=single) == 50
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = files.data_files(spark, out)
    assert (len(parts) == 1) == single
    first = open(parts[0].removeprefix("file:"), "rb").read()
    assert first[:2] == b"\xff\xfe" and first.endswith(b"\r\x00\n\x00")
    back = reviews.read_raw_reviews(spark, out)
    assert table(back) == table(source)


def test_landing_keeps_numbers(spark, tmp_path):
    path = write_utf16(tmp_path / "raw.txt", [row(i, "5", f"t{i}") for i in range(20)])
    landed = reviews.land_reviews(spark, path, str(tmp_path / "bronze"))
    assert [r[0] for r in table(landed)] == list(range(1, 21))


def test_publish_is_all_or_nothing(spark, tmp_path):
    target = str(tmp_path / "result")
    good = spark.range(10)
    assert sinks.publish(good, target) == 10

    def refuse(_):
        raise RuntimeError("refused")

    with pytest.raises(RuntimeError, match="refused"):
        sinks.publish(spark.range(3), target, check=refuse)
    with pytest.raises(RuntimeError, match="expected 4 rows"):
        sinks.publish(spark.range(3), target, expected_rows=4)
    assert spark.read.parquet(target).count() == 10
    assert sinks.publish(spark.range(3), target) == 3
    assert spark.read.parquet(target).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["result"]


def test_same_paths_are_refused(spark, tmp_path):
    a = str(tmp_path / "a")
    files.require_distinct_paths(spark, a, str(tmp_path / "b"))
    with pytest.raises(ValueError, match="must differ"):
        files.require_distinct_paths(spark, a, f"file:{a}/")


def test_scoring_csv_ids(spark, tmp_path):
    csv = tmp_path / "batch.csv"
    csv.write_text('﻿review,no\nواحد, 7 \n"two\nlines",8\n', encoding="utf-8")
    rows = reviews.assign_row_ids(reviews.read_scoring_reviews(spark, str(csv)), "batch")
    assert [r["source_row_id"] for r in rows.orderBy(ROW_NUMBER).collect()] == ["7", "8"]
    csv.write_text("review\na\nb\n", encoding="utf-8")
    rows = reviews.read_scoring_reviews(spark, str(csv))
    named = reviews.assign_row_ids(rows, "batch").orderBy(ROW_NUMBER)
    assert [r["source_row_id"] for r in named.collect()] == ["batch:2", "batch:3"]
    csv.write_text("text\na\n", encoding="utf-8")
    with pytest.raises(ValueError, match="missing required columns"):
        reviews.read_scoring_reviews(spark, str(csv))


def test_labelled_csv_gate(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text("review,rating,sentiment\nجيد,5,positive\nسيء,1,negative\n", encoding="utf-8")
    rows = reviews.read_labelled(spark, str(path), fmt="csv")
    assert rows.columns == ["review", "sentiment"] and rows.count() == 2
    path.write_text("review,sentiment\n,positive\n", encoding="utf-8")
    with pytest.raises(ValueError, match="null_value"):
        reviews.read_labelled(spark, str(path), fmt="csv")
    path.write_text("review,sentiment\n", encoding="utf-8")
    with pytest.raises(ValueError, match="empty"):
        reviews.read_labelled(spark, str(path), fmt="csv")


def test_splits_audit_report_and_manifest(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "a", "positive", "train"), (2, "b,\"c", "negative", "test")],
        "source_row_number bigint, review string, sentiment string, split string",
    )
    assert sinks.write_splits(rows, str(tmp_path / "splits")) == 2
    assert spark.read.parquet(str(tmp_path / "splits")).where("split = 'train'").count() == 1
    sinks.export_splits_csv(rows, str(tmp_path / "csv"))
    assert reviews.read_labelled(spark, str(tmp_path / "csv" / "split=test"), fmt="csv").first()["review"] == 'b,"c'
    sinks.write_report(spark.createDataFrame([(2, None)], "b int, a string"), str(tmp_path / "report"))
    (part,) = [p for p in (tmp_path / "report").iterdir() if p.suffix == ".json"]
    assert part.read_text() == '{"a":null,"b":2}\n'
    listed = manifest.file_manifest(spark, str(part)).first()
    import hashlib

    assert listed["sha256"] == hashlib.sha256(part.read_bytes()).hexdigest()
    assert listed["bytes"] == part.stat().st_size


def test_load_test_folder(spark, tmp_path):
    from marginalia.operators.loadtest import load_test_rollup
    from marginalia.sources import loadtests

    head = "Type,Name,Request Count,Failure Count,Requests/s,50%,95%,99%\n"
    for run, (count, rps) in enumerate([(495, 8.37), (498, 8.41)], start=1):
        (tmp_path / f"web-u1-r{run}_stats.csv").write_text(
            head + f"POST,/predict,{count},0,{rps},1,1,1\n,Aggregated,{count},0,{rps},110,180,220\n"
        )
        (tmp_path / f"web-u1-r{run}_docker_stats.csv").write_text(
            "timestamp_utc,cpu_percent,memory_usage,memory_bytes,memory_percent\n"
            f"t,{run * 100},349.6MiB / 2GiB,366582169,17.07\nt,--,x,y,z\n"
        )
    (tmp_path / "smoke-web_stats.csv").write_text(head + ",Aggregated,9999,9,1,1,1,1\n")
    requests = loadtests.read_requests(spark, str(tmp_path))
    row = load_test_rollup(requests, loadtests.read_samples(spark, str(tmp_path))).first()
    assert (row["service"], row["runs"], row["requests"], row["failures"]) == ("web", 2, 993, 0)
    assert row["mean_rps"] == pytest.approx(8.39) and row["peak_cpu_percent"] == 200
    (tmp_path / "web-u1-r3_stats.csv").write_text(head + "POST,/predict,1,0,1,1,1,1\n")
    with pytest.raises(RuntimeError, match="run 3 is missing"):
        loadtests.read_requests(spark, str(tmp_path))


def test_a_reader_always_finds_a_whole_version(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        commits.read(spark, path)
    commits.publish(spark.range(100), path)
    stop, seen, failed = threading.Event(), set(), []

    def watch():
        while not stop.is_set():
            try:
                seen.add(commits.read(spark, path).count())
            except Exception as error:  # the point of the test
                failed.append(error)

    reader = threading.Thread(target=watch)
    reader.start()
    for n in range(2, 7):
        commits.publish(spark.range(100 * n), path)
    stop.set()
    reader.join()
    assert not failed and seen <= {100 * n for n in range(1, 7)}
    assert commits.versions(spark, path) == [1, 2, 3, 4, 5, 6] and commits.read(spark, path, 2).count() == 200
    assert commits.retire(spark, path, keep=2) == [1, 2, 3, 4]
    assert commits.read(spark, path).count() == 600 and commits.versions(spark, path) == [5, 6]
    with pytest.raises(FileNotFoundError):
        commits.read(spark, path, 1)


def test_of_two_writers_one_wins(spark, tmp_path):
    path = str(tmp_path / "table with space")
    commits.publish(spark.range(1), path)
    with ThreadPoolExecutor(4) as pool:
        tries = [pool.submit(commits.publish, spark.range(n), path, base=1) for n in (10, 20, 30, 40)]
    errors = [t.exception() for t in tries]
    assert errors.count(None) == 1 and all(isinstance(e, commits.CommitConflict) for e in errors if e)
    assert commits.versions(spark, path) == [1, 2]
    won = next(t.result() for t in tries if t.exception() is None)
    assert commits.read(spark, path).count() == won.rows
    # The rows of those that lost are gone.
    assert len([p for p in (tmp_path / "table with space").iterdir() if p.name.startswith("data-")]) == 2


def test_a_failed_commit_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")

    def refuse(written):
        raise RuntimeError("refused")

    for options in ({"expected_rows": 4}, {"check": refuse}):
        with pytest.raises(RuntimeError):
            commits.publish(spark.range(3), path, **options)
    assert commits.versions(spark, path) == [] and list((tmp_path / "table").iterdir()) == []
    # A version may be made from the one before.
    commits.publish(spark.range(3), path)
    commits.publish(commits.read(spark, path).unionAll(spark.range(2)), path)
    assert commits.read(spark, path).count() == 5 and commits.entry(spark, path).rows == 5

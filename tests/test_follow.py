"""Following growing files: appended lines once, line numbers, restarts."""

import random

import pytest
from pyspark.sql import functions as F

from topicflow.streaming.follow import Follower


class Sink:
    def __init__(self):
        self.rows, self.steps = [], []

    def __call__(self, batch, number):
        own = [(r.file.rsplit("/", 1)[1], r.line_no, bytes(r.value).decode()) for r in batch.collect()]
        self.rows += own
        self.steps.append((number, sorted(own)))


def _expected(texts):
    out = []
    for name, text in texts.items():
        whole = text[: text.rindex("\n") + 1] if "\n" in text else ""
        out += [(name, i + 1, line.strip()) for i, line in enumerate(whole.split("\n")) if line.strip()]
    return sorted(out)


@pytest.mark.parametrize("piece, max_bytes", [(1 << 20, 1 << 30), (7, 1 << 30), (16, 50)])
def test_appended_lines_are_read_once(spark, scratch, piece, max_bytes):
    folder, ck, sink, texts = scratch("in"), scratch("ck"), Sink(), {}
    rng = random.Random(piece)
    for round_ in range(4):
        for name in ("a.jsonl", "b.jsonl")[: 1 + (round_ > 1)]:
            more = "".join(rng.choice(['{"n": 1}', "é" * 9, "", "  \t", "x" * 40, "y"]) + "\n" for _ in range(6))
            more += rng.choice(["", '{"half'])  # a line that isn't finished yet
            texts[name] = texts.get(name, "") + more
            with open(f"{folder}/{name}", "a", encoding="utf-8") as f:
                f.write(more)
        Follower(spark, folder, ck, max_bytes=max_bytes, piece=piece).drain(sink)  # a restart each time
        assert sorted(sink.rows) == _expected(texts)
    if max_bytes == 50:
        assert all(sum(len(v.encode()) for _, _, v in rows) <= 50 for _, rows in sink.steps) and len(sink.steps) > 5


def test_a_failed_step_comes_again_and_a_replaced_file_is_read_anew(spark, scratch):
    folder, ck, sink = scratch("in"), scratch("ck"), Sink()
    with open(f"{folder}/a", "w") as f:
        f.write("one\ntwo\n")

    def fail(batch, number):
        sink(batch, number)
        raise RuntimeError("handler failed")
    with pytest.raises(RuntimeError):
        Follower(spark, folder, ck).drain(fail)
    with open(f"{folder}/a", "a") as f:
        f.write("three\n")
    follower = Follower(spark, folder, ck)
    follower.drain(sink)
    assert sink.steps[0] == sink.steps[1] and sink.steps[2][1] == [("a", 3, "three")]
    assert follower.next_poll() is None
    with open(f"{folder}/a", "w") as f:
        f.write("new\n")
    follower.drain(sink)
    assert sink.steps[-1][1] == [("a", 1, "new")]


def test_a_line_longer_than_a_step_and_one_without_end(spark, scratch):
    folder, sink = scratch("in"), Sink()
    with open(f"{folder}/a", "w") as f:
        f.write("z" * 3_000_000 + "\nshort\n" + "w" * 100)
    follower = Follower(spark, folder, scratch("ck"), max_bytes=1000, piece=500_000)
    follower.drain(sink)
    assert sorted((n, len(v)) for _, n, v in sink.rows) == [(1, 3_000_000), (2, 5)] and follower.next_poll() is None


def test_records_are_ready_to_publish(spark, scratch):
    folder = scratch("in")
    with open(f"{folder}/a", "w") as f:
        f.write('{"n": 1}\r\n')
    follower = Follower(spark, folder, scratch("ck"))
    row = follower.records(follower.next_poll()).select("key", F.col("value").cast("string"), "line_no").first()
    assert tuple(row) == (None, '{"n": 1}', 1)

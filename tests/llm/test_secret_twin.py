"""The scan and its DuckDB twin on runs in parts, and the scan on long texts."""

import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from faregate.llm import secrets
from faregate.llm.oracle import ORACLE
from tests.llm.frames import documents

SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def drawn(draw, length, signs=SIGNS):
    return "".join(draw.choice(signs) for _ in range(length))


def texts(count=250, seed=11):
    draw = random.Random(seed)
    bits = [
        lambda: drawn(draw, draw.randint(5, 60)), lambda: drawn(draw, draw.randint(20, 40), "0123456789abcdef"),
        lambda: "AKIA" + drawn(draw, draw.randint(10, 20), "ABCDEFGH0123456789"), lambda: "token=" + drawn(draw, draw.randint(3, 30)),
        lambda: "example", lambda: "word-word-2024", lambda: "🙂é", lambda: "xxxx", lambda: "secret: '", lambda: "a" * 26 + "1",
    ]
    return ["".join(draw.choice(bits)() + draw.choice(["", "", "/", "=", " ", "_", "+"]) for _ in range(draw.randint(1, 9))) for _ in range(count)]


def test_same_spans_as_the_twin(spark):
    rows = [(i, t, None, "s") for i, t in enumerate([*texts(), None, ""])]
    got = secrets.scan(documents(spark, rows)).select("id", secrets.joined(F.concat("base", "added")).alias("spans"))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    wanted = con.execute(f"SELECT doc_id, spans FROM ({ORACLE['op7_secrets']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(wanted)
    assert sum("entropy" in s for _, s in wanted) > 40


def long_text(kind):
    draw = random.Random(5)
    if kind == "one run":
        return drawn(draw, 100_000), 0, 1
    if kind == "hex strings":
        return " ".join(drawn(draw, 24, "0123456789abcdef") for _ in range(40_000)), 40_000, 0
    if kind == "a path":
        return "/".join(f"word{draw.randint(0, 99)}" for _ in range(100_000)), 0, 0
    return (drawn(draw, 24, "0123456789abcdef") + "G" * 30) * 5_000, 5_000, 0


@pytest.mark.parametrize("kind", ["one run", "hex strings", "a path", "pieces of one run"])
def test_long_texts_take_time_in_proportion(spark, kind):
    text, base, added = long_text(kind)
    scan = lambda t: secrets.scan(documents(spark, [(1, t, None, "s")])).select(F.size("base"), F.size("added")).collect()
    began = time.time()
    scan("short")  # planning
    planned = time.time() - began
    assert [tuple(r) for r in scan(text)] == [(base, added)]
    assert time.time() - began - 2 * planned < 20

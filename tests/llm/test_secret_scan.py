from __future__ import annotations

import base64
import hashlib
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tabforge.llm import secret_scan as ss
from tabforge.llm.queries import op7_secret_randomness
from tests.llm.data import awkward_rows, documents, sentence

PATTERNS = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 8),
    ("access", re.compile(r"(AKIA[A-Z0-9]+)"), 1, 16),
    ("hex", re.compile(r"([0-9a-f]+)"), 1, 32),
]


def base(text: str | None) -> list[tuple]:
    found = []
    for no, (_, pattern, group, least) in enumerate(PATTERNS):
        found += [(m.start(), no, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return sorted(found)


def texts() -> list[str | None]:
    rng = random.Random(3)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(64))
    return [
        *[t for _, t, *_ in awkward_rows()],
        "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" and é😀 password:short password: longenough1",
        "token=secret: abcdefghij, API_KEY='x.y-z_12345' apikey : \"abcd\" passwd=12345678",
        "AKIAABCDEFGHIJKL12 AKIASHORT xAKIA0123456789AB " + "a" * 31 + "g" + "b" * 32,
        "secret=" * 300 + "tail12345",
        f"a key {key} in a text, and a plain identifier ThisIsSectionFourOfTheDocument",
        "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
        "thisisaverylongordinaryword andanotherquitelongordinaryword0 1111111111111111111111",
    ]


def test_spans(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    found = ss.scan_secrets(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    extra = {}
    for r in found:
        assert [(s["start"], s["kind_no"], s["end"]) for s in r["base"]] == base(r["text"])
        spans = [(s["start"], s["kind_no"], s["end"]) for s in r["spans"]]
        assert spans == sorted(spans) and [s for s in spans if s[1] < 3] == base(r["text"])
        extra |= {(r["doc_id"], s): r["text"][s[0] : s[2]] for s in spans if s[1] == 3}
    assert [len(v) for v in extra.values()] == [64]  # the random key and nothing else


def test_randomness_against_generated_strings(spark):
    """Random keys of several encodings are found, ordinary words and identifiers are not."""
    rng = random.Random(11)
    random_keys = [base64.urlsafe_b64encode(rng.randbytes(33)).decode() for _ in range(60)]
    random_keys += ["".join(rng.choice(ss.ALPHABETS["base62"]) for _ in range(40)) for _ in range(60)]
    plain = [sentence(i, 9).replace(" ", rng.choice("_-")) for i in range(200)]
    plain += ["".join(w.capitalize() for w in sentence(i, 7).split()) + str(i) for i in range(200)]
    rows = [(i, f"see {k} there") for i, k in enumerate([*random_keys, *plain])]
    found = {r["doc_id"] for r in ss.scan_secrets(documents(spark, rows)).where(F.size("spans") > 0).collect()}
    assert len([i for i in found if i < 120]) >= 108
    assert not [i for i in found if i >= 120]


KEYS = [("lower", 20), ("lower", 32), ("lower", 40), ("base32", 20), ("base32", 32), ("HEX", 20), ("HEX", 32), ("hex", 20), ("hex", 24), ("hex", 31)]


def test_recall_by_encoding_and_length(spark):
    """Keys of one case are found as well; words run together in either case, numbers and dates are not."""
    rng, n = random.Random(12), 60
    keys = [(i, kind, size, "".join(rng.choice(ss.ALPHABETS[kind]) for _ in range(size))) for i, (kind, size) in enumerate(KEYS) for _ in range(n)]
    plain = [sentence(i, 9).replace(" ", "") for i in range(200)] + [sentence(i, 9).replace(" ", "").upper() for i in range(200)]
    plain += [f"{rng.randrange(10**24):024d}" for _ in range(100)] + [f"2024{rng.randrange(10**4):04d}T{rng.randrange(10**6):06d}Z0000{i:04d}" for i in range(100)]
    rows = [(i, f"see {k} there") for i, k in enumerate([*[k[3] for k in keys], *plain])]
    found = {r["doc_id"] for r in ss.scan_secrets(documents(spark, rows)).where(F.size("spans") > 0).collect()}
    recall = {KEYS[j]: sum(i in found for i in range(j * n, (j + 1) * n)) / n for j in range(len(KEYS))}
    print(recall)
    assert min(recall.values()) >= 0.8, recall
    assert not [i for i in found if i >= len(keys)]


def test_contract_digest(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts())]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    for r in op7_secret_randomness(spark, str(tmp_path)).collect():
        spans = base(rows[r["doc_id"]][1])
        line = ",".join(f"{PATTERNS[no][0]}:{a}:{z}" for a, no, z in spans)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == no for s in spans) for no in range(3)]
        assert r["spans"].startswith(line) or "random" in r["spans"]


def tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def plain_battery(value: str) -> dict[str, float]:
    """The three tests and their joint p-value, in numpy."""
    core = value.rstrip("=")
    letters = next((a for a in list(ss.ALPHABETS.values())[:-1] if set(core) <= set(a)), ss.ALPHABETS["mixed"])
    at = np.array([letters.index(c) + 1 for c in core], dtype=float)
    n, size, df = len(at), len(letters), len(letters) - 1
    counts = np.array([(at == k).sum() for k in range(1, size + 1)])
    chi = (((counts - n / size) ** 2) / (n / size)).sum()
    uniform = tail(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    high = at > size / 2
    ones, turns = high.sum(), (high[1:] != high[:-1]).sum()
    mean = 2 * ones * (n - ones) / n
    runs = min(1.0, 2 * tail(abs(turns - mean) / math.sqrt(mean * (mean - 1) / (n - 1)))) if 0 < ones < n else 2.0 ** (1 - n)
    off = at - at.mean()
    serial = min(1.0, 2 * tail(abs((off[1:] * off[:-1]).sum()) / max((off * off).sum(), 1e-9) * math.sqrt(n)))
    return {"uniform": uniform, "runs": runs, "serial": serial, "random": min(1.0, 3 * min(uniform, runs, serial))}


def generated() -> list[str]:
    rng = random.Random(5)
    keys = ["".join(rng.choice(a) for _ in range(n)) for a in ss.ALPHABETS.values() for n in (16, 20, 33, 64, 200) for _ in range(4)]
    return keys + [sentence(i, 9).replace(" ", "") for i in range(40)] + ["ab" * 20, "abcdefghijklmnopqrstuvwxyz", "0123456789" * 3]


def test_battery_against_numpy(spark):
    values = generated()
    found = spark.createDataFrame([(v,) for v in values], "v string").select("v", ss.battery(F.col("v")).alias("t")).select("v", "t.*").collect()
    for r in found:
        for name, p in plain_battery(r["v"]).items():
            assert abs(math.log(r[name] + 1e-12) - math.log(p + 1e-12)) < 0.25, (r["v"], name, r[name], p)
    short = spark.createDataFrame([("abc",), ("",)], "v string").select(ss.battery(F.col("v")).alias("t")).select("t.*").collect()
    assert all(r["random"] == r["text"] == 1.0 for r in short)


def test_random_runs_are_rarely_called_ordered(spark):
    """Of random runs about the stated share has a small joint p-value; ordered ones have the least."""
    rng = random.Random(6)
    keys = ["".join(rng.choice(ss.ALPHABETS[a]) for _ in range(40)) for a in ("hex", "base32", "base62") for _ in range(400)]
    found = [r[0] for r in spark.createDataFrame([(v,) for v in keys], "v string").select(ss.battery(F.col("v"))["random"]).collect()]
    assert np.mean(np.array(found) < 0.05) < 0.09 and np.mean(np.array(found) < 0.001) < 0.006
    ordered = spark.createDataFrame([("ab" * 20,), ("a" * 40,), ("abcdefghij" * 4,)], "v string").select(ss.battery(F.col("v"))["random"])
    assert max(r[0] for r in ordered.collect()) < 1e-3


def test_thresholds_are_benjamini_and_hochberg(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(4, 7), rng.choice([0, 0, 0, 1, 5, 12, 25, 40, 90])) for _ in range(600)]
    expected = {}
    for d in {d for d, _ in rows}:
        bins = sorted((b for e, b in rows if e == d), reverse=True)
        passed = [b for b in set(bins) if 10 ** (-b / 10) * len(bins) <= 0.01 * sum(x >= b for x in bins)]
        if passed:
            expected[d] = min(passed)
    assert ss.thresholds(spark.createDataFrame(rows, "doubling int, bin int"), 0.01) == expected
    assert ss.thresholds(spark.createDataFrame([], "doubling int, bin int"), 0.01) == {}


def test_redaction(spark):
    row = (1, "x token=abcdefghij y " + "0123456789abcdef" * 2)
    found = ss.scan_secrets(documents(spark, [row, (2, None), (3, "clean")]))
    masked = dict(found.select("doc_id", ss.redacted(F.col("text"), "spans")).collect())
    assert masked == {1: "x [SECRET] y [SECRET]", 2: None, 3: "clean"}


def test_empty_and_clashing(spark):
    assert ss.scan_secrets(documents(spark, [])).count() == 0
    clash = ss.scan_secrets(documents(spark, [(1, "t")]).selectExpr("*", "1 AS SPANS", "2 AS tested_runs"))
    assert clash.columns[-1] == "spans" and "tested_runs" in clash.columns and clash.count() == 1
    plan = clash._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

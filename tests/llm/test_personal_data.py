from __future__ import annotations

import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabforge.llm import personal_data as pii
from tabforge.llm.queries import OP13_SQL
from tests.llm.data import awkward_rows, documents, sentence

# The patterns of the four base kinds as they are stated, tried at every place.
PLAIN = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)
IBAN, CARD, SSN = "GB29 NWBK 6016 1331 9268 19", "4111 1111 1111 1111", "512-44-7781"


def plain_base(text: str) -> list[tuple[int, int, int]]:
    found = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = "".join(c for c in m[0] if c.isdigit())
            good = {
                0: True,
                1: all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else False,
                2: 14 <= len(digits) <= 19 and sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0,
                3: 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="aZ0159@.+-_ ()%é\n", max_size=60))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert [s[:3] for s in pii.spans_of(text, 60, 40) if s[1] < pii.BASE] == plain_base(text)


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("a@b.c_d@e.fg", ["email", "email"]),
        ("x@y z@", []),
        ("1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4", ["ip", "ip", "ip"]),
        (CARD, ["card"]),
        ("4111 1111 1111 1112", []),
        (f"12 {CARD}", []),
        ("+49 (30) 123-4", []),
        ("+49 (30) 123-45678.", ["phone"]),
        (f"pay to {IBAN} BIC ABCDEFGH", ["iban"]),
        (IBAN.replace("19", "18"), []),
        (f"ref {IBAN}7", []),
        (f"test invoice {IBAN}", []),
        (f"{SSN}", []),
        (f"her social security number {SSN}", ["ssn"]),
        ("SSN 000-44-7781, SSN 912-44-7781", []),
        # The address begins with the end of the account, so only it stays.
        (f"my iban {IBAN}@bank.example.com", ["email"]),
    ],
)
def test_kinds(text, kinds):
    found = pii.spans_of(text, 60, 40)
    assert [pii.KINDS[s[1]] for s in found] == kinds


def test_score_follows_the_words_nearby():
    def score(text):
        return [s[3] for s in pii.spans_of(text, 60, 40)]

    assert score(f"number {CARD}") == [70]
    assert score(f"credit card {CARD}") == [100]
    assert score(f"test number {CARD}") == [40]
    assert score("card" + " x" * 30 + f" {CARD}") == [70]
    assert score(f"{CARD} is on my VISA") == [100]


def test_validators():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112") and pii.luhn("0")
    assert pii.mod_97("GB29NWBK60161331926819") and pii.mod_97("DE89370400440532013000") and not pii.mod_97("DE88370400440532013000")


def rows() -> list[tuple]:
    long_text = sentence(3, 40_000) + f" mail me: jo.do+x@sub.example.org, card {CARD} " + "9" * 200_000 + "a" * 200_000 + " at 10.0.0.1"
    return [
        *awkward_rows(),
        (20, long_text),
        (21, f"😀 é {CARD}, {IBAN}; SSN {SSN}; +1 (743) 555-3824, a@b.cd"),
        (21, f"😀 é {CARD}, {IBAN}; SSN {SSN}; +1 (743) 555-3824, a@b.cd"),
        (22, "tel. +1 (743) 555-3824 test"),
    ]


def test_operator_on_awkward_texts(spark):
    docs = documents(spark, rows()).withColumn("spans", F.lit("clash")).withColumn("`odd`", F.lit(1))
    found = pii.find_personal_data(docs)
    assert set(found.columns) == set(docs.columns)
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r["doc_id"], []).append([tuple(s) for s in r["spans"]])
    assert by_id[1] == by_id[2] == by_id[3] == [[]] and by_id[5] == [[], []]
    long_text = rows()[-4][1]
    # The card's digits go on into a run of nines, which is too long for a card.
    assert [pii.KINDS[s[1]] for s in by_id[20][0]] == ["email", "ip"]
    assert by_id[20][0][-1][2] == len(long_text)
    assert by_id[21][0] == by_id[21][1] and [s[1] for s in by_id[21][0]] == [2, 4, 5, 3, 0]
    assert by_id[21][0][0][:3] == (4, 2, 4 + len(CARD))
    own = pii.find_personal_data(docs.select("doc_id", F.col("text").alias("spans")), text_col="spans")
    assert own.where("doc_id = 21").count() == 2 and own.select("spans").dtypes[0][1].startswith("array")
    assert pii.find_personal_data(documents(spark, [])).count() == 0


def test_query_equals_sql_on_awkward_texts(spark, tmp_path):
    from tabforge.llm.queries import op13_personal_data
    from tests.oracle import compare

    documents(spark, rows()).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(op13_personal_data(spark, str(tmp_path)), con, OP13_SQL) == []

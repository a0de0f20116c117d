"""Inputs at the edges of what numbers and texts can be."""

import time

import numpy as np
from pyspark.sql import functions as F

from sedimenta.llm import language_id, pii, range_join


def test_scans_of_long_texts_do_not_repeat():
    began = time.process_time()
    for piece in ("token", "1://", "a://", "iban", "secret=", "a@", "+1", "1.", "1 "):
        text = piece * (1_000_000 // len(piece))
        found = pii.find(text)
        assert all(a < b <= len(text) for spans in found.values() for a, b in spans)
    assert time.process_time() - began < 60


def test_account_numbers_with_a_checksum():
    def accounts(text):
        return [text[a:b] for a, b in pii.find(text)["account"]]

    assert accounts("iban DE89 3704 0044 0532 0130 00 please") == ["DE89 3704 0044 0532 0130 00"]
    assert accounts("IBAN: GB82WEST12345698765432.") == ["GB82WEST12345698765432"]
    assert accounts("iban DE89 3704 0044 0532 0130 01") == []  # wrong sum
    assert accounts("iban DE89 3704") == [] and accounts("iban ") == [] and accounts("iban") == []
    assert accounts("account 1234567890123") == ["1234567890123"]
    # A cue inside a run that held no value, and a value behind it.
    assert accounts("tokentokentoken token=abcd12345678") == ["abcd12345678"]


def test_more_languages_than_a_byte_counts():
    scores = np.zeros((6, 200))
    scores[:3, 150] = scores[3:, 190] = 9.0
    assert language_id.viterbi(scores, np.array([0, 6]), 2.0).tolist() == [150] * 3 + [190] * 3


def test_links_of_very_large_and_very_small_vectors(spark):
    rows = [(1, [1e200, 0.0]), (2, [2e200, 0.0]), (3, [1e-200, 1e-210]), (4, [5e-324, 0.0]), (5, [0.0, 1e300]), (6, [1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rep", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id) for r in range_join.near_vectors(table).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 5: (0, 5), 6: (4, 1)}

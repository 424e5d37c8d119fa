"""Rows without an id have the results that the docstrings name."""

import public_tokenizers
import pytest
from pyspark.sql import SparkSession

from runledger.llm import language, licenses, packing


@pytest.fixture(scope="module")
def docs():
    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
    return spark.createDataFrame([(None, "one two three SPDX-License-Identifier: MIT", "en"), (1, "one two three", "en"), (None, "vier", "de")], "doc_id long, text string, lang string")


def test_languages_are_predicted_but_not_learned(docs):
    got = language.predict(docs).collect()
    assert len(got) == 3 and {r["lang_pred"] for r in got} == {"en"} and not any(r["held_out"] for r in got if r["doc_id"] is None)


def test_licenses_are_found_under_a_null_id(docs):
    assert [r["doc_id"] for r in licenses.find_licenses(docs).collect()] == [None]


def test_rows_are_packed_each(docs):
    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted((r["doc_id"] is None, r["piece"], r["start"]) for r in got) == [(False, 0, 0), (True, 0, 0), (True, 0, 0)]

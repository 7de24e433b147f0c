"""The base columns of quality rules need no vocabulary, and are those of the whole measures."""

import public_tokenizers

from quarry.llm import base_columns, fertility


def test_no_text_is_encoded_for_the_base_columns(spark, sf, monkeypatch):
    whole = fertility.measures(spark.read.parquet(f"{sf}/documents.parquet"))
    monkeypatch.setattr(public_tokenizers, "path", None)  # no vocabulary can be found
    base = base_columns.q_rule_base(spark, sf)
    assert sorted(base.collect()) == sorted(whole.select(*base.columns).collect())

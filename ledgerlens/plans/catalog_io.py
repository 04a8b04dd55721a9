"""Registered queries: raw CSV landing round trip and the baseline models."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerlens.plans import ml, pipeline
from ledgerlens.plans.registry import register, with_ledger
from ledgerlens.session import checkpoint_dir, scratch_path
from ledgerlens.sources import files
from ledgerlens.sources.bindings import RAW_COLUMNS, event_ledger, ledger


@register("raw_csv_roundtrip", with_ledger("SELECT " + ", ".join(f'"{c}"' for c in RAW_COLUMNS) + " FROM ledger"))
def raw_csv_roundtrip(spark, sf):
    """The transaction table written as the raw CSV layout to the
    shared folder, read back with the declared schema."""
    path = scratch_path(spark, f"raw_csv/{uuid.uuid4().hex[:8]}")
    pipeline.ledger_as_raw_csv(ledger(spark, sf), path, compression="gzip")
    return files.read_raw_csv(spark, path).select(*RAW_COLUMNS)


@register("baseline_model_eval")   # iterative training: rows-only check
def baseline_model_eval(spark, sf):
    # training iterates over the data: materialise the features once in the
    # shared checkpoint folder instead of recomputing windows per iteration
    checkpoint_dir(spark)
    feats = ml.feature_table(event_ledger(spark, sf, ml.INPUT)).checkpoint(eager=True)
    train, test = ml.time_split(feats)
    return ml.evaluate(ml.train_baselines(train), test)

"""Evaluation records and precomputed vectors to ranking accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.functions.keys import SEED
from pairforge.operators.catalogue import row_cap
from pairforge.operators.retrieval import (
    TEMPERATURE,
    candidate_logits,
    expand_candidates,
    expected_random_accuracy,
    random_predictions,
    rank_candidates,
    ranking_accuracy,
)


def evaluate(
    records: DataFrame,
    query_reps: DataFrame,
    target_reps: DataFrame,
    max_samples: int | None = None,
    id_col: str = "style_id",
    scale: float = 1 / TEMPERATURE,
    seed: int = SEED,
) -> DataFrame:
    """One row: accuracy, correct and total of the model, and the accuracy of guessing.

    ``query_reps`` are ``(id, vec)``, ``target_reps`` are ``(passage_path, vec)``. Records without
    candidates are not counted.
    """
    sampled = row_cap(records, max_samples, id_col)
    pairs = expand_candidates(sampled, id_col).select(id_col, "cand_pos", "passage_path")
    logits = candidate_logits(pairs, query_reps, target_reps, id_col, "passage_path", scale)
    truths = sampled.select(
        id_col, "ground_truth_index", F.coalesce(F.size("candidate_targets"), F.lit(0)).alias("num_candidates")
    )
    ranked = rank_candidates(logits, id_col).select(id_col, "predicted_index")
    model = ranking_accuracy(truths.join(ranked, id_col, "left"))
    guessed = ranking_accuracy(random_predictions(truths, id_col, seed=seed))
    return model.select(
        "accuracy", "correct", "total",
        guessed.select("accuracy").scalar().alias("guessed_accuracy"),
        expected_random_accuracy(truths).scalar().alias("expected_random_accuracy"),
    )

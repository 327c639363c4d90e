"""Near embeddings: work per vector as tables grow, blocks, groups of many pairs, single precision."""

import math

import numpy as np
import pytest

from ledgerloom.llm import collision_projections as near


def links_of(data, cosine=0.9):
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    return (unit @ unit.T >= cosine).sum(axis=1) - 1


def found_by(spark, data, kind="double", **kwargs):
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], f"vec_id long, embedding array<{kind}>")
    found = {r["vec_id"]: r for r in near.near_vectors(frame, **kwargs).collect()}
    return [found[i] for i in range(len(data))]


@pytest.fixture(scope="module")
def families():
    """Three families of 12 near vectors each among 40 others."""
    rng = np.random.default_rng(21)
    return np.concatenate([rng.standard_normal((40, 24)), *(c + 0.05 * rng.standard_normal((12, 24)) for c in rng.standard_normal((3, 24)))])


@pytest.mark.parametrize("rows", [10 ** 5, 10 ** 6, 10 ** 7])
def test_work_of_a_vector_grows_with_the_root_of_the_rows(rows):
    directions, bound = near.calibrate(rows)
    share = 0.5 * math.erfc(bound / math.sqrt(2.0))
    assert directions * near.both_above(bound, near.COSINE) >= 0.99 * near.MEAN_COLLISIONS
    # Projections, and rows of the tails that it is in.
    assert directions + directions * share * rows * share <= 60 * math.sqrt(rows)


def test_no_link_counts_twice_where_blocks_of_a_tail_are_empty(spark, families):
    found = found_by(spark, families, block=2, least=64)
    assert [r["n_links"] for r in found] == links_of(families).tolist()
    assert [r["component_id"] for r in found[40:]] == [40 + i // 12 * 12 for i in range(36)]


def test_a_group_of_more_pairs_than_are_taken_at_once(spark):
    rng = np.random.default_rng(23)
    data = np.concatenate([rng.standard_normal(32) + 0.02 * rng.standard_normal((600, 32)), rng.standard_normal((50, 32))])
    found = found_by(spark, data)
    assert [(r["n_links"], r["component_id"]) for r in found] == [(599, 0)] * 600 + [(0, i) for i in range(600, 650)]


def test_single_precision_links_like_double(spark, families):
    data = families.astype(np.float32)
    assert found_by(spark, data, "float") == found_by(spark, data.astype(np.float64), "double")
    assert [r["n_links"] for r in found_by(spark, data, "float", block=20, least=64)] == links_of(data.astype(np.float64)).tolist()

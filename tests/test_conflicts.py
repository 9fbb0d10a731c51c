"""First come, first kept under two unique keys, against the sequential rule."""

import random

import pytest
from helpers import rows

from obstar.operators.components import of_rows
from obstar.operators.conflicts import TooManyRounds, insert_ignore_all

PAIR = "code int, text string"
OFFER = "code int, text string, at int"


def sequential(target, offers):
    kept = list(target)
    codes, texts = {c for c, _ in kept}, {t for _, t in kept}
    for code, text, _ in sorted(offers, key=lambda o: o[2]):
        if code not in codes and text not in texts:
            kept.append((code, text))
            codes.add(code)
            texts.add(text)
    return sorted(kept, key=repr)


def insert(spark, target, offers, **options):
    return rows(
        insert_ignore_all(
            spark.createDataFrame(target, PAIR),
            spark.createDataFrame(offers, OFFER),
            [["code"], ["text"]],
            ["at"],
            **options,
        )
    )


def test_not_the_same_as_one_key_after_the_other(spark):
    offers = [(1, "A", 1), (2, "A", 2), (2, "B", 3)]
    assert insert(spark, [], offers) == [(1, "A"), (2, "B")]


def test_existing_rows_win(spark):
    offers = [(1, "B", 1), (2, "A", 2), (2, "C", 3)]
    assert insert(spark, [(1, "A")], offers) == [(1, "A"), (2, "C")]


@pytest.mark.parametrize("seed", range(5))
def test_random_offers(spark, seed):
    rng = random.Random(seed)
    offers = [(rng.randrange(25), f"t{rng.randrange(25)}", at) for at in range(150)]
    target = [(100, "t1"), (3, "u")]
    assert insert(spark, target, offers) == sequential(target, offers)


def test_one_code_holds_a_third(spark):
    rng = random.Random(11)
    offers = [
        (0 if at % 3 == 0 else rng.randrange(1, 200), f"t{rng.randrange(400)}", at) for at in range(900)
    ]
    assert insert(spark, [], offers) == sequential([], offers)


CHAIN = [(i // 2, f"t{(i + 1) // 2}", i) for i in range(12)]


def test_chain_of_conflicts(spark):
    assert insert(spark, [], CHAIN) == sequential([], CHAIN)


def test_rounds_can_be_bounded(spark):
    with pytest.raises(TooManyRounds, match="rows undecided after 1 rounds"):
        insert(spark, [], CHAIN, max_rounds=1)


def test_long_chain_takes_few_steps(spark):
    """10,000 links, each row in the way of the next."""
    links = [(i // 2, f"t{(i + 1) // 2}", i) for i in range(10_000)]
    assert insert(spark, [], links, max_rounds=2) == sequential([], links)


@pytest.mark.parametrize("group", [1, 4])
def test_components_settled_in_parts(spark, group):
    rng = random.Random(group)
    more = [(50 + rng.randrange(6), f"u{rng.randrange(6)}", 100 + at) for at in range(40)]
    offers = [*CHAIN[: 4 + 2 * group], *more]
    assert insert(spark, [], offers, group=group) == sequential([], offers)


def test_components_of_rows(spark):
    found = spark.createDataFrame(
        [(5, 1, "a"), (3, 1, "b"), (9, 2, "b"), (4, 7, "x"), (6, 8, "y"), (8, 8, "z")], "n long, k int, t string"
    )
    assert rows(of_rows(found, "n", [["k"], ["t"]], "c")) == [(3, 3), (5, 3), (6, 6), (8, 6), (9, 3)]


def test_chain_of_many_groups_takes_few_steps(spark):
    """A chain much longer than the rows that are settled together."""
    links = [(i // 2, f"t{(i + 1) // 2}", i) for i in range(3000)]
    assert insert(spark, [], links, group=10, max_rounds=2) == sequential([], links)


@pytest.mark.parametrize("seed", range(3))
def test_chains_that_fork_and_meet(spark, seed):
    """Chains in no order, with rows across them: roots that are open, and rows below them."""
    rng = random.Random(seed)
    at = list(range(400))
    rng.shuffle(at)
    offers = [(i // 2, f"t{(i + 1) // 2}", i) for i in range(300)]
    offers += [(1000 + i // 2, f"u{(i + 1) // 2}", 1000 + at[i]) for i in range(300)]
    offers += [(rng.randrange(150), f"t{rng.randrange(150)}", rng.randrange(2000)) for _ in range(10 * seed)]
    assert insert(spark, [], offers, group=7) == sequential([], offers)

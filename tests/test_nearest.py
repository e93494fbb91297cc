import random

import pytest

from locrank.operators import near_names, nearest, nearest_names


def apart(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def names(spark, values):
    return spark.createDataFrame([(v, 1) for v in values], "name string, gram int")


@pytest.mark.parametrize("distance, q", [(1, 2), (1, 3), (2, 2)])
def test_against_all_pairs(spark, distance, q):
    draw = random.Random(distance * 10 + q)
    known = ["".join(draw.choices("abcé ", k=draw.randint(0, 9))) for _ in range(80)] + ["a" * 30, "ab" * 12, "Holy See", "Taiwan*"]
    lost = ["".join(draw.choices("abcé ", k=draw.randint(0, 9))) for _ in range(60)]
    lost += [k[: len(k) // 2] + draw.choice(["", "x", "é"]) + k[len(k) // 2 + draw.randint(0, 1) :] for k in known]
    lost += ["a" * 31, "a" * 29 + "b", "ab" * 12 + "b", "Taiwan", "", None, "Vatican"]
    expected = {(a, b, apart(a, b)) for a in lost if a is not None for b in known if apart(a, b) <= distance}
    found = [tuple(r) for r in near_names(names(spark, lost), names(spark, [*known, known[0], None]), distance, q).collect()]
    assert len(found) == len(set(found)) and set(found) == expected


def test_nearest_of_several_and_of_none(spark):
    found = nearest_names(names(spark, ["Taiwan", "Holy Sea", "Vatican", "Mali"]), names(spark, ["Taiwan*", "Holy See", "Holy Se", "Bali", "Mala"]))
    assert {tuple(r) for r in found.collect()} == {
        ("Taiwan", "Taiwan*", 1),
        ("Holy Sea", "Holy Se", 1),
        ("Vatican", None, None),
        ("Mali", "Bali", 1),
    }
    assert nearest_names(names(spark, []), names(spark, ["a"])).count() == 0
    plan = near_names(names(spark, ["a"]), names(spark, ["b"]))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("most", [1, 12, 10_000])
def test_names_of_any_length_against_all_pairs(spark, monkeypatch, most):
    """By grams alone, by both ways, and by rests alone."""
    monkeypatch.setattr(nearest, "MOST_RESTS", most)
    test_against_all_pairs(spark, 1, 3)


def test_names_that_begin_alike_meet_few_others(spark):
    """Numbered names have most of their grams in common; the pairs that are compared grow with the names."""
    known = spark.range(3000).selectExpr("printf('Customer#%09d', id) as name")
    lost = known.selectExpr("replace(name, 'Customer', 'Custommer') as name")
    signs = nearest._signs(lost, known, 1, 3)
    met = signs.where("side = 0").select("sign", "name").join(signs.where("side = 1").select("sign"), "sign")
    assert met.count() <= 4 * 3000
    near = near_names(lost, known)
    assert near.where("replace(name, 'mm', 'm') = near and distance = 1").count() == near.count() == 3000

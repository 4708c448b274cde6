"""Molecular graphs on hand-worked molecules, shuffled writings and unreadable texts."""

import pytest
from pyspark.sql import functions as F

from assayspark.functions import molecule as m
from assayspark.operators import features


@pytest.fixture(scope="module")
def derived(spark):
    def run(texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "id int, structure string")
        made = features.per_structure(
            rows, "structure", bits=m.circular_bits, key=m.graph_key, scaffold=m.scaffold_key, kept=m.scaffold_atoms, c=m.graph_counts, g=lambda g: g
        )
        return [r for r in made.orderBy("id").collect()]

    return run


COUNTS = {  # atoms, hydrogens, donors, acceptors, rotatable bonds, rings, ring atoms, share of tetrahedral carbon
    "CCO": (3, 6, 1, 1, 0, 0, 0, 1.0),
    "CCCC": (4, 10, 0, 0, 1, 0, 0, 1.0),
    "c1ccccc1C(=O)N": (9, 7, 1, 2, 1, 1, 6, 0.0),
    "CC(=O)Oc1ccccc1C(=O)O": (13, 8, 1, 4, 3, 1, 6, 1 / 9),
    "[nH]1cccc1": (5, 5, 1, 1, 0, 1, 5, 0.0),
    "n1ccccc1": (6, 5, 0, 1, 0, 1, 6, 0.0),
    "Cn1cccc1": (6, 7, 0, 1, 0, 1, 5, 0.2),
    "CS(=O)(=O)N": (5, 5, 1, 3, 0, 0, 0, 1.0),
    "[O-]C(=O)C": (4, 3, 0, 2, 0, 0, 0, 0.5),
    "C1CCC2CCCCC2C1": (10, 18, 0, 0, 0, 2, 10, 1.0),
    "c1ccccc1c1ccccc1": (12, 10, 0, 0, 1, 2, 12, 0.0),
    "CC#N": (3, 3, 0, 1, 0, 0, 0, 0.5),
    "C.[Na+]": (2, 4, 0, 0, 0, 0, 0, 1.0),
    "C%12CC%12": (3, 6, 0, 0, 0, 1, 3, 1.0),
    "[NH4+]": (1, 4, 1, 1, 0, 0, 0, None),
}


def test_counts(derived):
    for text, r in zip(COUNTS, derived(list(COUNTS))):
        assert tuple(r.c)[:-1] == COUNTS[text][:-1], text
        assert r.c.fraction_sp3 == pytest.approx(COUNTS[text][-1]), text


def test_unreadable_texts_have_nothing(derived):
    for r in derived(["C(", "CC)", "C1CC", "", None, "C?", "(C)C", "1CC1", "C11", "Xx"]):
        assert r.g is None and r.bits is None and r.key is None and r.scaffold is None and r.kept is None and r.c is None, r.structure


@pytest.mark.parametrize(
    "spellings",
    [
        ["CCO", "OCC", "C(O)C", "[CH3][CH2][OH]"],
        ["CC(=O)Oc1ccccc1C(=O)O", "OC(=O)c1c(OC(C)=O)cccc1", "c1cc(C(=O)O)c(OC(=O)C)cc1"],
        ["C1CCC2CCCCC2C1", "C12CCCCC1CCCC2", "C1CCCC2C1CCCC2"],
        ["C1CCCC1C1CCCC1", "C1(CCCC1)C1CCCC1"],
        ["c1ccc2ccccc2c1CC3CC3", "C1CC1Cc2cccc3ccccc23"],
        ["F/C=C/F", "FC=CF"],
        ["O=C([O-])C", "CC([O-])=O"],
    ],
)
def test_keys_do_not_depend_on_the_writing(derived, spellings):
    rows = derived(spellings)
    assert len({r.key for r in rows}) == 1 and len({tuple(r.bits) for r in rows}) == 1 and len({r.scaffold for r in rows}) == 1


def test_different_molecules_have_different_keys(derived):
    texts = ["CCO", "COC", "CCN", "CC=O", "C1CCC2CCCCC2C1", "C1CCCC1C1CCCC1", "c1ccccc1", "C1CCCCC1", "C1CCCC1", "CC(=O)[O-]", "CC(=O)O", "n1ccccc1", "CCCC", "CC(C)C"]
    rows = derived(texts)
    assert len({r.key for r in rows}) == len(texts)


SCAFFOLDS = {  # text -> places of the scaffold's atoms
    "CCO": [],
    "c1ccccc1CCN": [0, 1, 2, 3, 4, 5],
    "CC1CC1CCC2CCC2C": [1, 2, 3, 4, 5, 6, 7, 8, 9],
    "O=C1CCCC1C": [0, 1, 2, 3, 4, 5],  # atoms double-bonded to a ring stay
    "C1CC1C(=O)C1CC1": [0, 1, 2, 3, 4, 5, 6, 7],  # and those double-bonded to a link
    "C1CC1C(C)(C)C1CC1": [0, 1, 2, 3, 6, 7, 8],
    "CCCC(c1ccccc1)CC": [4, 5, 6, 7, 8, 9],
}


def test_scaffolds(derived):
    for text, r in zip(SCAFFOLDS, derived(list(SCAFFOLDS))):
        assert r.kept == SCAFFOLDS[text], text
        assert (r.scaffold == "") == (not SCAFFOLDS[text])
    same = derived(["Cc1ccccc1", "c1ccccc1CC(N)CC", "c1cc(Br)ccc1"])
    assert len({r.scaffold for r in same}) == 1 and len({r.key for r in same}) == 3


def test_environments_by_hand(derived):
    """Ethane has one kind of atom, propane two; each radius adds one environment a kind."""
    ethane, propane, ring = derived(["CC", "CCC", "C1CCCCC1"])
    assert len(ethane.bits) == 3 and len(propane.bits) == 6 and len(ring.bits) == 3
    assert not set(ring.bits) & set(propane.bits)
    near = derived(["CCCCCCO", "CCCCCCCO"])
    shared = set(near[0].bits) & set(near[1].bits)
    assert len(shared) >= 10  # the ends of both chains look alike


def test_every_row_of_a_structure_and_long_texts(spark):
    long = "C" * 400 + "1CC1"
    rows = spark.createDataFrame([(i, s, "x") for i, s in enumerate(["CCO", "CCO", None, long, "CCO"])], "id int, structure string, key string")
    made = features.per_structure(rows, "structure", c=m.graph_counts, bits=m.circular_bits)
    assert made.columns == ["id", "structure", "key", "c", "bits"]
    got = {r.id: r.c for r in made.collect()}
    assert got[0] == got[1] == got[4] and got[2] is None and tuple(got[3])[:2] == (402, 804) and got[3].rings == 1
    assert features.per_structure(rows.where("false"), "structure", key2=m.graph_key).count() == 0

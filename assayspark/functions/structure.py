"""Expressions over structure strings in SMILES notation. All stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from assayspark.functions.literals import let

# Standard atomic weights of the elements (of the longest-lived isotope where none is stable).
ATOMIC_WEIGHT = {
    "H": 1.008, "He": 4.003, "Li": 6.941, "Be": 9.012, "B": 10.812, "C": 12.011, "N": 14.007, "O": 15.999,
    "F": 18.998, "Ne": 20.180, "Na": 22.990, "Mg": 24.305, "Al": 26.982, "Si": 28.086, "P": 30.974, "S": 32.067,
    "Cl": 35.453, "Ar": 39.948, "K": 39.098, "Ca": 40.078, "Sc": 44.956, "Ti": 47.867, "V": 50.942, "Cr": 51.996,
    "Mn": 54.938, "Fe": 55.845, "Co": 58.933, "Ni": 58.693, "Cu": 63.546, "Zn": 65.39, "Ga": 69.723, "Ge": 72.61,
    "As": 74.922, "Se": 78.96, "Br": 79.904, "Kr": 83.80, "Rb": 85.468, "Sr": 87.62, "Y": 88.906, "Zr": 91.224,
    "Nb": 92.906, "Mo": 95.94, "Tc": 98.0, "Ru": 101.07, "Rh": 102.906, "Pd": 106.42, "Ag": 107.868, "Cd": 112.412,
    "In": 114.818, "Sn": 118.711, "Sb": 121.760, "Te": 127.60, "I": 126.904, "Xe": 131.29, "Cs": 132.905, "Ba": 137.328,
    "La": 138.906, "Ce": 140.116, "Pr": 140.908, "Nd": 144.24, "Pm": 145.0, "Sm": 150.36, "Eu": 151.964, "Gd": 157.25,
    "Tb": 158.925, "Dy": 162.50, "Ho": 164.930, "Er": 167.26, "Tm": 168.934, "Yb": 173.04, "Lu": 174.967, "Hf": 178.49,
    "Ta": 180.948, "W": 183.84, "Re": 186.207, "Os": 190.23, "Ir": 192.217, "Pt": 195.078, "Au": 196.967, "Hg": 200.59,
    "Tl": 204.383, "Pb": 207.2, "Bi": 208.980, "Po": 209.0, "At": 210.0, "Rn": 222.0, "Fr": 223.0, "Ra": 226.0,
    "Ac": 227.0, "Th": 232.038, "Pa": 231.036, "U": 238.029, "Np": 237.0, "Pu": 244.0, "Am": 243.0, "Cm": 247.0,
    "Bk": 247.0, "Cf": 251.0, "Es": 252.0, "Fm": 257.0, "Md": 258.0, "No": 259.0, "Lr": 262.0, "Rf": 267.0,
    "Db": 268.0, "Sg": 271.0, "Bh": 272.0, "Hs": 277.0, "Mt": 276.0, "Ds": 281.0, "Rg": 280.0, "Cn": 285.0,
    "Nh": 284.0, "Fl": 289.0, "Mc": 288.0, "Lv": 293.0, "Ts": 294.0, "Og": 294.0,
}

# An atom is a bracket group or one of the bare symbols; hydrogen in brackets is dropped later.
ATOM_PATTERN = r"\[[^\]]*\]|Br|Cl|[BCNOPSFI]|[bcnops]"
SYMBOL_PATTERN = r"^\[?[0-9]*([A-Z][a-z]?|[a-z]{1,2}).*$"
BRACKET_PATTERN = r"\[[^\]]*\]"
CLOSURE_PATTERN = r"%[0-9]{2}|[0-9]"


def atom_symbols(structure: Column) -> Column:
    """Element symbols as written (aromatic ones in lower case), one per heavy atom."""
    tokens = F.regexp_extract_all(structure, F.lit(ATOM_PATTERN), F.lit(0))
    symbols = F.transform(tokens, lambda t: F.regexp_replace(t, SYMBOL_PATTERN, "$1"))
    return F.filter(symbols, lambda s: s.rlike("^[A-Za-z]+$") & (s != "H"))


def token_counts(structure: Column) -> Column:
    """A struct of counts that need no molecular graph; null structure gives nulls."""
    weights = F.create_map(*[F.lit(x) for pair in ATOMIC_WEIGHT.items() for x in pair])
    closures = F.regexp_extract_all(
        F.regexp_replace(structure, BRACKET_PATTERN, ""), F.lit(CLOSURE_PATTERN), F.lit(0)
    )

    def element(s: Column) -> Column:
        return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1))

    def counts(atoms: Column) -> Column:
        return F.struct(
            F.size(atoms).alias("heavy_atoms"),
            F.aggregate(atoms, F.lit(0.0), lambda acc, s: acc + weights[element(s)]).alias("heavy_weight"),
            F.size(F.filter(atoms, lambda s: ~s.isin("C", "c"))).alias("hetero_atoms"),
            F.floor(F.size(closures) / 2).cast("int").alias("ring_count"),
            F.size(F.filter(atoms, lambda s: s.isin("F", "Cl", "Br", "I"))).alias("halogens"),
            F.size(F.filter(atoms, lambda s: s == F.lower(s))).alias("aromatic_atoms"),
        )

    return F.when(structure.isNotNull(), let(atom_symbols(structure), counts))


def text_hash(text: Column) -> Column:
    """First 32 bits of the md5 as a non-negative number; equal on any engine that has md5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hashed_bits(text: Column, n_bits: int = 2048, window: int = 4) -> Column:
    """Sorted on-bits: each `window` characters of the whole text hash to one of `n_bits` positions.

    One scan steps over the characters and looks ahead, so the work is linear in the length of the
    text, and equal pieces are hashed once. Text shorter than the window gives no bits.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{window}}}))."), F.lit(1))
    bits = F.transform(F.array_distinct(pieces), lambda g: (text_hash(g) % n_bits).cast("int"))
    return F.sort_array(F.array_distinct(bits))


def structure_key(structure: Column) -> Column:
    """Text-level key: the longest fragment (the first of equals) without stereo marks."""

    def longest(parts: Column) -> Column:
        most = F.array_max(F.transform(parts, F.length))
        return F.element_at(parts, F.array_position(F.transform(parts, F.length), most).cast("int"))

    return F.regexp_replace(let(F.split(structure, r"\."), longest), r"[@/\\]", "")

"""Molecular graphs read from SMILES, and what follows from them. All expressions stay on the JVM and within their row.

A text is one pass over its tokens: atoms, bonds, branches (a stack of atoms) and ring closures (marks that are still open).
Each atom has one earlier neighbour at most, its parent, so the bonds to parents form a tree and every closure closes one
cycle of it; a bond is in a ring if it lies on one of those cycles. Null, empty and unreadable texts (unbalanced branches,
open closures, unknown characters) have no graph, and all that is derived from it is null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from assayspark.functions.literals import let
from assayspark.functions.structure import ATOM_PATTERN, SYMBOL_PATTERN, text_hash

TOKEN_PATTERN = ATOM_PATTERN + r"|%[0-9]{2}|[0-9]|[-=#$:/\\().]"
# Usual valences; of several the smallest that holds the bonds counts.
VALENCES = {"B": [3], "C": [4], "N": [3, 5], "O": [2], "P": [3, 5], "S": [2, 4, 6], "F": [1], "Cl": [1], "Br": [1], "I": [1]}

_STATE = """struct<n: int, last: int, kind: string, stack: array<int>, open: array<struct<mark: string, atom: int, kind: string>>,
  bonds: array<struct<a: int, b: int, kind: string, closure: boolean>>, bad: boolean>"""


def _read(tokens: Column) -> Column:
    """The state after all tokens."""
    start = F.from_json(F.lit('{"n": 0, "last": -1, "kind": "", "stack": [], "open": [], "bonds": [], "bad": false}'), _STATE)

    def step(s: Column, t: Column) -> Column:
        atom, mark = t.rlike(r"^[\[A-Za-z]"), t.rlike("^[%0-9]")
        known = F.filter(s["open"], lambda o: o["mark"] == t)
        seen = F.get(known, F.lit(0))
        bond = lambda a, b, kind, closure: F.array(F.struct(a.alias("a"), b.alias("b"), kind.alias("kind"), F.lit(closure).alias("closure")))
        return F.struct(
            F.when(atom, s["n"] + 1).otherwise(s["n"]).alias("n"),
            F.when(atom, s["n"]).when(t == ")", F.coalesce(F.get(s["stack"], F.size(s["stack"]) - 1), F.lit(-1))).when(t == ".", F.lit(-1)).otherwise(s["last"]).alias("last"),
            F.when(t.rlike(r"^[-=#$:/\\]"), t).otherwise(F.lit("")).alias("kind"),
            F.when(t == "(", F.concat(s["stack"], F.array(s["last"])))
            .when((t == ")") & (F.size(s["stack"]) > 0), F.slice(s["stack"], F.lit(1), F.size(s["stack"]) - 1))
            .otherwise(s["stack"])
            .alias("stack"),
            F.when(mark & seen.isNull(), F.concat(s["open"], F.array(F.struct(t.alias("mark"), s["last"].alias("atom"), s["kind"].alias("kind")))))
            .when(mark, F.filter(s["open"], lambda o: o["mark"] != t))
            .otherwise(s["open"])
            .alias("open"),
            F.when(atom & (s["last"] >= 0), F.concat(s["bonds"], bond(s["last"], s["n"], s["kind"], False)))
            .when(mark & seen.isNotNull(), F.concat(s["bonds"], bond(seen["atom"], s["last"], F.when(s["kind"] == "", seen["kind"]).otherwise(s["kind"]), True)))
            .otherwise(s["bonds"])
            .alias("bonds"),
            (s["bad"] | ((t == ")") & (F.size(s["stack"]) == 0)) | ((mark | (t == "(")) & (s["last"] < 0)) | (mark & seen["atom"].eqNullSafe(s["last"]))).alias("bad"),
        ).cast(_STATE)

    return F.aggregate(tokens, start, step)


def _atom(token: Column) -> Column:
    """What an atom's own token says."""
    symbol = F.regexp_replace(token, SYMBOL_PATTERN, "$1")
    sign, size = (F.regexp_extract(token, r"^\[.*?([+-]+)([0-9]*)(?::[0-9]+)?\]$", i) for i in (1, 2))
    amount = F.when(size != "", size.try_cast("int")).otherwise(F.length(sign))
    hydrogens = F.regexp_extract(token, r"^\[[0-9]*(?:[A-Z][a-z]?|[a-z]{1,2})@*(H[0-9]*)", 1)
    return F.struct(
        F.initcap(symbol).alias("element"),
        (symbol == F.lower(symbol)).alias("aromatic"),
        F.when(sign.startswith("-"), -amount).otherwise(amount).alias("charge"),
        F.when(token.startswith("["), F.when(hydrogens == "", 0).when(hydrogens == "H", 1).otherwise(F.substring(hydrogens, 2, 9).try_cast("int"))).alias("hydrogens"),
    )


def _with_rings(tokens: Column, state: Column) -> Column:
    """atoms with their parents, degree and hydrogens, bonds with their kind; r marks what is in a ring."""
    own = F.transform(F.filter(tokens, lambda t: t.rlike(r"^[\[A-Za-z]")), _atom)
    count = state["n"]
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    tree = F.filter(state["bonds"], lambda b: ~b["closure"])

    def ringed(parents: Column) -> Column:
        def above(atom: Column) -> Column:
            """The atom and all its ancestors."""
            climb = F.aggregate(places, F.array(atom), lambda path, _: F.when(F.get(parents, path[F.size(path) - 1]) >= 0, F.concat(path, F.array(F.get(parents, path[F.size(path) - 1])))).otherwise(path))
            return climb

        # the cycle of a closure: the atoms that only one of its ends has above it, each with the bond to its parent
        cycles = F.transform(
            F.filter(state["bonds"], lambda b: b["closure"]),
            lambda b: let(F.struct(above(b["a"]).alias("x"), above(b["b"]).alias("y")), lambda p: F.struct(F.array_union(F.array_except(p["x"], p["y"]), F.array_except(p["y"], p["x"])).alias("low"), F.array_max(F.array_intersect(p["x"], p["y"])).alias("top"))),
        )
        return let(
            F.struct(F.flatten(F.transform(cycles, lambda c: c["low"])).alias("low"), F.transform(cycles, lambda c: c["top"]).alias("tops")),
            lambda r: finished(parents, r["low"], F.array_union(r["low"], r["tops"])),
        )

    def finished(parents: Column, low: Column, ring: Column) -> Column:
        def kind(b: Column) -> Column:
            both = F.get(own, b["a"])["aromatic"] & F.get(own, b["b"])["aromatic"]
            ring = b["closure"] | F.array_contains(low, b["b"])  # the other bonds of the tree link rings
            plain = F.when((b["kind"] == "") & both & ring, ":").when(b["kind"].isin("", "/", "\\"), "-").otherwise(b["kind"])
            return F.concat(plain, F.when(ring, "r").otherwise(""))

        bonds = F.transform(state["bonds"], lambda b: F.struct(b["a"].alias("a"), b["b"].alias("b"), kind(b).alias("kind")))

        def atoms(bonds: Column) -> Column:
            def full(a: Column, i: Column) -> Column:
                mine = F.filter(bonds, lambda b: (b["a"] == i) | (b["b"] == i))
                near = F.transform(mine, lambda b: F.struct(F.when(b["a"] == i, b["b"]).otherwise(b["a"]).alias("to"), b["kind"].alias("kind")))
                order = lambda x: F.when(x["kind"].startswith("="), 2).when(x["kind"].startswith("#"), 3).when(x["kind"].startswith("$"), 4).otherwise(1)
                return let(near, lambda near: let(F.aggregate(near, F.lit(0), lambda n, x: n + order(x)), lambda used: F.struct(
                    a["element"].alias("element"), a["aromatic"].alias("aromatic"), a["charge"].alias("charge"),
                    F.coalesce(a["hydrogens"], _implicit(a, used)).alias("hydrogens"),
                    F.get(parents, i).alias("parent"), F.array_contains(ring, i).alias("ring"), near.alias("near"),
                )))

            return F.transform(own, full)

        return let(bonds, lambda bonds: F.struct(atoms(bonds).alias("atoms"), bonds.alias("bonds")))

    parents = F.transform(places, lambda i: F.coalesce(F.get(F.filter(tree, lambda b: b["b"] == i), F.lit(0))["a"], F.lit(-1)))
    return let(parents, ringed)


def _implicit(atom: Column, used: Column) -> Column:
    """Hydrogens that a bare atom has: what its valence leaves. An aromatic atom uses one more, but for oxygen and sulphur."""
    out = F.lit(0)
    for element, valences in VALENCES.items():
        rest = F.lit(0)
        for v in reversed(valences):
            rest = F.when(used <= v, v - used).otherwise(rest)
        aromatic = F.greatest(valences[0] - used - F.lit(0 if element in ("O", "S") else 1), F.lit(0))
        out = F.when(atom["element"] == element, F.when(atom["aromatic"], aromatic).otherwise(rest)).otherwise(out)
    return out


def graph(structure: Column) -> Column:
    """atoms (element, aromatic, charge, hydrogens, parent, ring, near (to, kind)) and bonds (a, b, kind), or null."""
    tokens = F.regexp_extract_all(structure, F.lit(TOKEN_PATTERN), F.lit(0))

    def made(t: Column) -> Column:
        whole = F.length(F.array_join(t, "")) == F.length(structure)
        return let(_read(t), lambda s: F.when(whole & ~s["bad"] & (s["n"] > 0) & (F.size(s["open"]) == 0) & (F.size(s["stack"]) == 0), _with_rings(t, s)))

    return F.when(structure.isNotNull(), let(tokens, made))


def _first_codes(atoms: Column) -> Column:
    return F.transform(atoms, lambda a: text_hash(F.concat_ws("|", a["element"], F.size(a["near"]).cast("string"), a["hydrogens"].cast("string"), a["charge"].cast("string"), a["ring"].cast("int").cast("string"))))


def _next_codes(atoms: Column, codes: Column, turn: Column) -> Column:
    """Each atom's code and those of its neighbours, in order, as the code of a larger environment."""

    def wider(c: Column, i: Column) -> Column:
        seen = F.transform(F.get(atoms, i)["near"], lambda n: F.concat(n["kind"], F.lit(" "), F.lpad(F.get(codes, n["to"]).cast("string"), 10, "0")))
        return text_hash(F.concat_ws("|", turn.cast("string"), c.cast("string"), F.array_join(F.sort_array(seen), ",")))

    return F.transform(codes, wider)


def circular_bits(g: Column, n_bits: int = 2048, radius: int = 2) -> Column:
    """Sorted on-bits: the environments of every atom up to `radius` bonds away, hashed to positions."""

    def folded(codes: Column) -> Column:
        return F.sort_array(F.array_distinct(F.transform(codes, lambda c: (c % n_bits).cast("int"))))

    def grown(turn: int, codes: Column, found: Column) -> Column:
        if turn > radius:
            return folded(found)
        return let(_next_codes(g["atoms"], codes, F.lit(turn)), lambda c: grown(turn + 1, c, F.concat(found, c)))

    return F.when(g.isNotNull(), let(_first_codes(g["atoms"]), lambda c: grown(1, c, c)))


def _refined(atoms: Column) -> Column:
    """Codes of atoms, refined until a round parts none further, which takes as many rounds as there are atoms at most."""
    start = F.struct(_first_codes(atoms).alias("codes"), F.lit(False).alias("done"))
    classes = lambda codes: F.size(F.array_distinct(codes))

    def step(s: Column, turn: Column) -> Column:
        after = let(_next_codes(atoms, s["codes"], turn), lambda x: F.when(classes(x) > classes(s["codes"]), F.struct(x.alias("codes"), F.lit(False).alias("done"))).otherwise(F.struct(s["codes"].alias("codes"), F.lit(True).alias("done"))))
        return F.when(s["done"], s).otherwise(after)

    return F.aggregate(F.sequence(F.lit(1), F.size(atoms)), start, step)["codes"]


def _key(atoms: Column) -> Column:
    """Text that doesn't depend on the order of writing: elements with their counts, then a hash of all atoms' codes."""
    elements = F.sort_array(F.transform(atoms, lambda a: a["element"]))
    counts = F.transform(F.array_distinct(elements), lambda e: F.concat(e, F.size(F.filter(elements, lambda x: x == e)).cast("string")))
    codes = F.transform(F.sort_array(_refined(atoms)), lambda c: c.cast("string"))
    return F.concat(F.array_join(counts, ""), F.lit(" "), F.substring(F.md5(F.array_join(codes, ",")), 1, 16))


def graph_key(g: Column) -> Column:
    """The same for all writings of a molecule. Molecules that colour refinement can't tell apart share a key; rings are marked
    on atoms and bonds, so fused and linked rings differ."""
    return F.when(g.isNotNull(), let(g["atoms"], _key))


def _only(atoms: Column, kept: Column) -> Column:
    """The part of the atoms, numbered anew."""

    def trimmed(a: Column) -> Column:
        near = F.filter(a["near"], lambda n: F.array_contains(kept, n["to"]))
        near = F.transform(near, lambda n: F.struct((F.array_position(kept, n["to"]) - 1).cast("int").alias("to"), n["kind"].alias("kind")))
        return a.withField("hydrogens", F.lit(0)).withField("near", near)

    return F.transform(kept, lambda i: trimmed(F.get(atoms, i)))


def scaffold_atoms(g: Column) -> Column:
    """Places of the ring systems, of what links them, and of atoms double-bonded to either; empty without a ring."""
    atoms = g["atoms"]
    places = F.sequence(F.lit(0), F.size(atoms) - 1)

    def above(i: Column) -> Column:
        up = lambda path: F.get(atoms, path[F.size(path) - 1])["parent"]
        return F.aggregate(places, F.array(i), lambda path, _: F.when(up(path) >= 0, F.concat(path, F.array(up(path)))).otherwise(path))

    def linked(paths: Column) -> Column:
        # all that is above a ring atom, down from the lowest atom that is above all of them
        shared = F.aggregate(paths, F.get(paths, F.lit(0)), lambda x, p: F.array_intersect(x, p))
        return F.array_union(F.array_except(F.array_distinct(F.flatten(paths)), shared), F.array(F.array_max(shared)))

    def doubled(kept: Column) -> Column:
        more = F.filter(places, lambda i: F.exists(F.get(atoms, i)["near"], lambda n: n["kind"].startswith("=") & F.array_contains(kept, n["to"])))
        return F.sort_array(F.array_union(kept, more))

    rings = F.filter(places, lambda i: F.get(atoms, i)["ring"])
    empty = F.array().cast("array<int>")
    return F.when(g.isNotNull(), let(rings, lambda r: F.when(F.size(r) > 0, let(F.transform(r, above), lambda p: let(linked(p), doubled))).otherwise(empty)))


def scaffold_key(g: Column) -> Column:
    """Key of the scaffold, empty for molecules without rings. Hydrogens don't count, as side chains are gone."""
    return F.when(g.isNotNull(), let(scaffold_atoms(g), lambda kept: F.when(F.size(kept) > 0, let(_only(g["atoms"], kept), _key)).otherwise(F.lit(""))))


def graph_counts(g: Column) -> Column:
    """Counts that need the graph: donors, acceptors, rotatable bonds, rings, ring atoms, share of tetrahedral carbon."""
    atoms, bonds = g["atoms"], g["bonds"]
    hetero = lambda a: a["element"].isin("N", "O")
    carbons = F.filter(atoms, lambda a: a["element"] == "C")
    flat = lambda a: a["aromatic"] | F.exists(a["near"], lambda n: n["kind"].rlike("^[=#$:]"))
    turning = F.filter(bonds, lambda b: (b["kind"] == "-") & (F.size(F.get(atoms, b["a"])["near"]) > 1) & (F.size(F.get(atoms, b["b"])["near"]) > 1))
    fragments = F.size(F.filter(atoms, lambda a: a["parent"] < 0))
    return F.when(
        g.isNotNull(),
        F.struct(
            F.size(atoms).alias("atoms"),
            F.aggregate(atoms, F.lit(0), lambda n, a: n + a["hydrogens"]).alias("hydrogens"),
            F.size(F.filter(atoms, lambda a: hetero(a) & (a["hydrogens"] > 0))).alias("donors"),
            F.size(F.filter(atoms, hetero)).alias("acceptors"),
            F.size(turning).alias("rotatable_bonds"),
            (F.size(bonds) - F.size(atoms) + fragments).alias("rings"),
            F.size(F.filter(atoms, lambda a: a["ring"])).alias("ring_atoms"),
            F.try_divide(F.size(F.filter(carbons, lambda a: ~flat(a))), F.size(carbons)).alias("fraction_sp3"),
        ),
    )

"""Queries over molecular graphs, on structures whose number grows with the table; a third of the rows is one molecule."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayspark.functions import molecule, structure as st
from assayspark.operators import features, similarity
from assayspark.plans import reports
from workload.registry import VIEWS, q6, query, rounded, view

# A hot molecule in two spellings; else a head, a chain, a middle, a chain and a tail by the digits of the key.
MOLECULES = """select p_partkey as id, case when p_partkey % 3 = 0 then
    case when p_partkey % 2 = 0 then 'CC(=O)Oc1ccccc1C(=O)O' else 'OC(=O)c1c(OC(C)=O)cccc1' end
  else concat(case p_partkey % 7 when 0 then 'C' when 1 then 'c1ccccc1' when 2 then 'C1CCNCC1' when 3 then 'c1ccc2ccccc2c1'
      when 4 then 'N#C' when 5 then 'O=C1CCCC1' else 'C1CCC2CCCCC2C1' end,
    repeat('C', cast(floor(p_partkey / 7) % 9 as int)),
    case floor(p_partkey / 63) % 6 when 0 then '' when 1 then 'C(=O)N' when 2 then 'C(C)(C)' when 3 then 'c1ccc(Cl)cc1'
      when 4 then 'S(=O)(=O)' else '/C=C/' end,
    repeat('C', cast(1 + floor(p_partkey / 378) % 9 as int)),
    case floor(p_partkey / 3402) % 6 when 0 then 'O' when 1 then '[N+](=O)[O-]' when 2 then 'C1CC1' when 3 then 'n1cccc1'
      when 4 then 'C(F)(F)F' else 'c1ccccc1' end,
    case when p_partkey % 5 = 0 then '.[Na+]' else '' end) end as structure
from {part}"""

VIEWS["molecules"] = MOLECULES.format(part="part")


def molecules(spark, sf):
    return view(spark, sf, MOLECULES)


def derived(spark, sf, whole: bool = True, **columns):
    """Molecules with what follows from their graphs, of the whole text or of its main fragment."""
    text = F.col("structure") if whole else st.structure_key(F.col("structure"))
    return features.per_structure(molecules(spark, sf), "structure", text, **columns)


def keyed(spark, sf):
    return derived(spark, sf, False, key=molecule.graph_key, scaffold=molecule.scaffold_key)


VALENCE = "case element when 'B' then {b} when 'C' then {c} when 'N' then {n} when 'O' then {o} when 'P' then {n} when 'S' then {s} else {x} end"
MAIN = r"regexp_replace(list_extract(string_split(structure, '.'), list_position(list_transform(string_split(structure, '.'), lambda x: length(x)), list_max(list_transform(string_split(structure, '.'), lambda x: length(x))))), '[@/\\]', '', 'g')"


def graph_sql(text: str = "structure") -> str:
    """The same graphs by recursion over tokens and joins over atoms and bonds; distinct texts once."""
    hash32 = lambda x: f"('0x' || substr(md5({x}), 1, 8))::bigint"
    return rf"""mol as (select distinct {text} as s from molecules),
    tok as (select s, regexp_extract_all(s, '{molecule.TOKEN_PATTERN}') as toks from mol),
    st as (with recursive st as (select s, toks, 0 as i, 0 as n, -1 as prev, '' as kind, []::int[] as stack,
        []::struct(mark varchar, atom int, kind varchar)[] as held, []::struct(a int, b int, kind varchar, closure boolean)[] as bonds from tok
      union all select s, toks, i + 1, case when atom then n + 1 else n end,
        case when atom then n when t = ')' then stack[len(stack)] when t = '.' then -1 else prev end,
        case when regexp_matches(t, '^[-=#$:/\\]') then t else '' end,
        case when t = '(' then list_append(stack, prev) when t = ')' then stack[:len(stack) - 1] else stack end,
        case when mark and seen is null then list_append(held, {{'mark': t, 'atom': prev, 'kind': kind}})
          when mark then list_filter(held, lambda o: o.mark <> t) else held end,
        case when atom and prev >= 0 then list_append(bonds, {{'a': prev, 'b': n, 'kind': kind, 'closure': false}})
          when mark and seen is not null then list_append(bonds, {{'a': seen.atom, 'b': prev, 'kind': case when kind = '' then seen.kind else kind end, 'closure': true}})
          else bonds end
      from (select *, regexp_matches(t, '^[\[A-Za-z]') as atom, regexp_matches(t, '^[%0-9]') as mark, list_filter(held, lambda o: o.mark = t)[1] as seen
        from (select *, toks[i + 1] as t from st where i < len(toks))))
      select s, n, bonds from st where i = len(toks)),
    bond as (select s, x.a, x.b, x.kind as raw, x.closure from (select s, unnest(bonds) as x from st)),
    token as (select s, t, (row_number() over (partition by s order by pos) - 1)::int as i from
      (select s, unnest(toks) as t, unnest(range(len(toks))) as pos from tok) where regexp_matches(t, '^[\[A-Za-z]')),
    own as (select s, i, regexp_replace(t, '{st.SYMBOL_PATTERN}', '\1') as symbol, regexp_extract(t, '^\[.*?([+-]+)([0-9]*)(:[0-9]+)?\]$', 1) as sign,
        regexp_extract(t, '^\[.*?([+-]+)([0-9]*)(:[0-9]+)?\]$', 2) as size, t like '[%' as boxed,
        regexp_extract(t, '^\[[0-9]*(?:[A-Z][a-z]?|[a-z]{{1,2}})@*(H[0-9]*)', 1) as h from token),
    up as (with recursive up as (select s, i as start, i as node from own union all
        select up.s, start, b.a from up join bond b on b.s = up.s and b.b = up.node and not b.closure) select * from up),
    cyc as (select s, a, b, row_number() over () as c from bond where closure),
    sides as (select cyc.s, c, node, count(*) as k from cyc join up on up.s = cyc.s and (up.start = cyc.a or up.start = cyc.b) group by all),
    low as (select distinct s, node from sides where k = 1),
    ring as (select s, node from low union select s, max(node) from sides where k = 2 group by s, c),
    atom0 as (select own.s, own.i, upper(symbol[1]) || symbol[2:] as element, symbol = lower(symbol) as aromatic, boxed, h,
        (case when sign like '-%' then -1 else 1 end) * (case when size <> '' then size::int else length(sign) end) as charge, ring.node is not null as in_ring
      from own left join ring on ring.s = own.s and ring.node = own.i),
    bond2 as (select b.s, b.a, b.b, case when raw = '' and x.aromatic and y.aromatic and (closure or low.node is not null) then ':' when raw in ('', '/', '\') then '-' else raw end
        || case when closure or low.node is not null then 'r' else '' end as kind
      from bond b join atom0 x on x.s = b.s and x.i = b.a join atom0 y on y.s = b.s and y.i = b.b left join low on low.s = b.s and low.node = b.b),
    ends as (select s, a as i, b as other, kind from bond2 union all select s, b, a, kind from bond2),
    used as (select s, i, count(*) as degree, sum(case kind[1] when '=' then 2 when '#' then 3 when '$' then 4 else 1 end) as used from ends group by s, i),
    atoms as (select a.s, a.i, element, aromatic, charge, in_ring, coalesce(degree, 0)::int as degree,
        case when boxed then case h when '' then 0 when 'H' then 1 else h[2:]::int end
          when aromatic then greatest({VALENCE.format(b="3", c="4", n="3", o="2", s="2", x="1")} - coalesce(used, 0) - case when element in ('O', 'S') then 0 else 1 end, 0)
          else coalesce(list_filter({VALENCE.format(b="[3]", c="[4]", n="[3, 5]", o="[2]", s="[2, 4, 6]", x="[1]")}, lambda v: v >= coalesce(used, 0))[1] - coalesce(used, 0), 0) end::int as hydrogens
      from atom0 a left join used using (s, i)),
    code0 as (select s, i, {hash32("concat_ws('|', element, degree, hydrogens, charge, in_ring::int)")} as code from atoms)"""


def wider_sql(name: str, before: str, turn: str) -> str:
    return f"""{name} as (select c.s, c.i, ('0x' || substr(md5(concat_ws('|', {turn}, c.code, coalesce(near, ''))), 1, 8))::bigint as code from {before} c left join
      (select e.s, e.i, string_agg(e.kind || ' ' || lpad(o.code::varchar, 10, '0'), ',' order by e.kind || ' ' || lpad(o.code::varchar, 10, '0')) as near
       from ends e join {before} o on o.s = e.s and o.i = e.other group by 1, 2) using (s, i))"""


BITS_SQL = f"""{graph_sql()}, {wider_sql("code1", "code0", "1")}, {wider_sql("code2", "code1", "2")},
    bits as (select distinct s, (code % 2048)::int as bit from (from code0 union all from code1 union all from code2))"""


@query("circular_bits", f"with {BITS_SQL} select id, bit from molecules join bits on s = structure", "molecules")
def circular_bits(spark, sf):
    return derived(spark, sf, bits=molecule.circular_bits).select("id", F.explode("bits").alias("bit"))


@query(
    "circular_nearest",
    f"""with {BITS_SQL}, sets as (select s, list_sort(list(bit)) as bits from bits group by s),
    asked as (select distinct bits from molecules join sets on s = structure),
    known as (select bits, min(id) as other from molecules join sets on s = structure where structure not like '%.%' group by bits),
    pairs as (select a.bits, other, len(list_intersect(a.bits, k.bits)) as c, len(a.bits) + len(k.bits) as n from asked a, known k),
    best as (select bits, max(c / (n - c)) as s, arg_min(other, (-c / (n - c), other)) as other from pairs where c / (n - c) >= 0.6 group by bits)
    select id, other as neighbour, {q6('best.s')} as similarity, best.s is not null as in_domain
    from molecules join sets on sets.s = structure left join best using (bits)""",
    "molecules",
)
def circular_nearest(spark, sf):
    """The nearest part without a counter-ion for every part, by circular environments."""
    rows = derived(spark, sf, bits=molecule.circular_bits)
    known = rows.where("structure not like '%.%'")
    return rounded(similarity.nearest_neighbours(rows.select("id", "bits"), known.select("id", "bits"), 0.6, 2048), "similarity")


def refined_sql(first: str, atoms: str, ends: str, name: str) -> str:
    """Colour refinement by recursion: a list of codes a molecule, until a round parts no atoms further."""
    return f"""{name}_near as (select a.s, list(coalesce(near, []) order by a.i) as near, list(code order by a.i) as codes, list(element order by element) as elements from {atoms} a
      join {first} using (s, i) left join (select s, i, list({{'o': other, 'k': kind}}) as near from {ends} group by s, i) using (s, i) group by a.s),
    {name} as (with recursive r as (select s, near, codes, elements, 0 as turn, false as done from {name}_near union all
      select s, near, case when same then codes else after end, elements, turn + 1, same from (select *, len(list_distinct(after)) = len(list_distinct(codes)) as same
        from (select *, list_transform(range(len(codes)), lambda i: ('0x' || substr(md5(concat_ws('|', turn + 1, codes[i + 1],
          array_to_string(list_sort(list_transform(near[i + 1], lambda n: n.k || ' ' || lpad(codes[n.o + 1]::varchar, 10, '0'))), ','))), 1, 8))::bigint) as after
        from r where not done)))
      select s, array_to_string(list_transform(list_sort(list_distinct(elements)), lambda e: e || len(list_filter(elements, lambda x: x = e))), '')
        || ' ' || substr(md5(array_to_string(list_sort(codes), ',')), 1, 16) as key from r where done)"""


SCAFFOLD_SQL = f"""{graph_sql(MAIN)}, {refined_sql("code0", "atoms", "ends", "whole")},
    rings as (select s, i from atoms where in_ring),
    chains as (select rings.s, up.start, node from rings join up on up.s = rings.s and up.start = rings.i),
    passed as (select s, node, count(*) = (select count(*) from rings r where r.s = chains.s) as by_all from chains group by s, node),
    linked as (select s, node as i from passed where not by_all union select s, max(node) from passed where by_all group by s),
    kept as (select s, i from linked union select e.s, e.i from ends e join linked l on l.s = e.s and l.i = e.other where e.kind like '=%'),
    places as (select s, i, (row_number() over (partition by s order by i) - 1)::int as place from kept),
    part_ends as (select e.s, x.place as i, y.place as other, e.kind from ends e join places x on x.s = e.s and x.i = e.i join places y on y.s = e.s and y.i = e.other),
    part_degree as (select s, i, count(*)::int as degree from part_ends group by s, i),
    part_atoms as (select a.s, place as i, element, aromatic, charge, in_ring, coalesce(d.degree, 0) as degree from places p join atoms a on a.s = p.s and a.i = p.i
      left join part_degree d on d.s = p.s and d.i = p.place),
    part_code as (select s, i, ('0x' || substr(md5(concat_ws('|', element, degree, 0, charge, in_ring::int)), 1, 8))::bigint as code from part_atoms),
    {refined_sql("part_code", "part_atoms", "part_ends", "part")},
    keyed as (select id, whole.key, coalesce(part.key, '') as scaffold from molecules join whole on whole.s = {MAIN} left join part on part.s = whole.s)"""


@query("graph_keys", f"with {SCAFFOLD_SQL} select * from keyed", "molecules")
def graph_keys(spark, sf):
    """Keys of whole molecules and of their scaffolds, by the main fragment."""
    return keyed(spark, sf).select("id", "key", "scaffold")


@query(
    "scaffold_report",
    f"""with {SCAFFOLD_SQL}, sub as (select *, id % 6 as subcluster from keyed),
    top as (select scaffold, count(*) as n from sub group by 1 order by n desc, scaffold limit 10),
    sized as (select *, sum(n) over (partition by subcluster) as total, row_number() over (partition by subcluster order by n desc, scaffold) as rk
      from (select subcluster, scaffold, count(*) as n from sub group by 1, 2))
    select -1 as subcluster, scaffold, n, null::double as percent from top where scaffold <> ''
    union all select subcluster, scaffold, n, {q6("100e0 * n / total")} from sized where rk <= 5 and scaffold <> ''""",
    "molecules",
)
def scaffold_report(spark, sf):
    """The most frequent scaffolds over all and per subcluster."""
    rows = keyed(spark, sf).select((F.col("id") % 6).alias("subcluster"), "scaffold")
    parts = reports.key_report(rows, "subcluster", "scaffold")
    overall = parts["overall"].select(F.lit(-1).cast("bigint").alias("subcluster"), "scaffold", "n", F.lit(None).cast("double").alias("percent"))
    return overall.unionByName(rounded(parts["per_subcluster"], "percent").select("subcluster", "scaffold", "n", "percent"))


@query(
    "keys_of_spellings",
    f"""with {SCAFFOLD_SQL}, sized as (select key, count(*) as n, count(distinct structure) as spellings, min(id) as first from keyed join molecules using (id) group by key)
    select * from sized""",
    "molecules",
)
def keys_of_spellings(spark, sf):
    """Rows, spellings and first row of every molecule: duplicates by structure are found however they are written."""
    rows = keyed(spark, sf)
    each = rows.groupBy("key", "structure").agg(F.count("*").alias("n"), F.min("id").alias("first"))  # the hot molecule has few spellings
    return each.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("spellings"), F.min("first").alias("first"))


@query(
    "graph_counts",
    f"""with {graph_sql()},
    a as (select s, count(*)::int as atoms, sum(hydrogens)::int as hydrogens, count(*) filter (element in ('N', 'O') and hydrogens > 0)::int as donors,
      count(*) filter (element in ('N', 'O'))::int as acceptors, count(*) filter (in_ring)::int as ring_atoms,
      count(*) filter (element = 'C')::int as carbons from atoms group by s),
    flat as (select s, count(*) filter (element = 'C' and not aromatic and (s, i) not in (select (s, i) from ends where regexp_matches(kind, '^[=#$:]'))) as sp3 from atoms group by s),
    b as (select s, count(*)::int as bonds, count(*) filter (kind = '-' and x.degree > 1 and y.degree > 1)::int as rotatable_bonds
      from bond2 join atoms x using (s) join atoms y using (s) where x.i = a and y.i = b group by s),
    roots as (select s, count(*)::int as fragments from atoms where (s, i) not in (select (s, b) from bond where not closure) group by s)
    select id, atoms, hydrogens, donors, acceptors, coalesce(rotatable_bonds, 0)::int as rotatable_bonds, (coalesce(bonds, 0) - atoms + fragments)::int as rings, ring_atoms,
      {q6("sp3 / nullif(carbons, 0)")} as fraction_sp3
    from molecules join a on a.s = structure join flat on flat.s = a.s join roots on roots.s = a.s left join b on b.s = a.s""",
    "molecules",
)
def graph_counts(spark, sf):
    rows = derived(spark, sf, c=molecule.graph_counts).select("id", "c.*")
    return rounded(rows, "fraction_sp3")

"""Queries over structures, bit sets and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayspark.functions import activity as act, structure as st
from assayspark.operators import cluster, features, similarity, stats
from workload.measures import cleaned
from workload.registry import activity_raw, bits, q6, query, r6, rounded, structures, table

# Token counts in SQL, from the same patterns.
SYMBOLS = rf"""list_filter(list_transform(regexp_extract_all(structure, '{st.ATOM_PATTERN}'),
  lambda t: regexp_replace(t, '{st.SYMBOL_PATTERN}', '\1')), lambda s: regexp_matches(s, '^[A-Za-z]+$') and s <> 'H')"""
WEIGHT = "map {" + ", ".join(f"'{k}': {v}e0" for k, v in st.ATOMIC_WEIGHT.items()) + "}"


def vectors(spark, sf):
    return bits(spark, sf).withColumn("features", features.dense_vector(F.col("embedding")))


@query(
    "token_counts",
    rf"""with atoms as (select id, structure, {SYMBOLS} as raw from structures),
    named as (select *, list_transform(raw, lambda s: concat(upper(s[1]), s[2:2])) as symbols from atoms)
    select id, cast(len(raw) as int) as heavy_atoms,
      {q6(f'list_sum(list_transform(symbols, lambda s: {WEIGHT}[s]))')} as heavy_weight,
      cast(len(list_filter(symbols, lambda s: s <> 'C')) as int) as hetero_atoms,
      cast(len(regexp_extract_all(regexp_replace(structure, '{st.BRACKET_PATTERN}', '', 'g'), '{st.CLOSURE_PATTERN}')) // 2 as int) as ring_count,
      cast(len(list_filter(symbols, lambda s: s in ('F', 'Cl', 'Br', 'I'))) as int) as halogens,
      cast(len(list_filter(raw, lambda s: regexp_matches(s, '^[a-z]'))) as int) as aromatic_atoms from named""",
    "structures",
)
def token_counts(spark, sf):
    return rounded(features.with_token_counts(structures(spark, sf)).drop("structure"), "heavy_weight")


def bits_sql(text: str, n_bits: int) -> str:
    return rf"""list_sort(list_distinct(list_transform(range(1, length({text}) - 2),
      lambda i: cast(('0x' || substr(md5(substr({text}, i, 4)), 1, 8))::bigint % {n_bits} as int))))"""


@query(
    "hashed_bits",
    f"select id, unnest({bits_sql('structure', 2048)}) as bit from structures",
    "structures",
)
def hashed_bits(spark, sf):
    rows = features.with_hashed_bits(structures(spark, sf))
    return rows.select("id", F.explode("bits").alias("bit"))


@query(
    "hashed_bits_documents",
    """with chars as (select doc_id, unnest(regexp_extract_all(text, '(?s).')) as ch,
      unnest(range(length(text))) as i from documents),
    pieces as (select doc_id, ch || lead(ch, 1) over w || lead(ch, 2) over w || lead(ch, 3) over w as g from chars
      window w as (partition by doc_id order by i))
    select doc_id, cast(count(distinct ('0x' || substr(md5(g), 1, 8))::bigint % 512) as int) as on_bits
    from pieces where g is not null group by doc_id""",
)
def hashed_bits_documents(spark, sf):
    """On-bits of whole texts, 512 positions."""
    rows = features.with_hashed_bits(table(spark, sf, "documents").select("doc_id", "text"), "text", n_bits=512)
    return rows.select("doc_id", F.size("bits").alias("on_bits"))


@query(
    "nonzero_rows",
    "select id, cast(len(list_filter(x, lambda v: v > 0.2)) as int) as on_bits from bits "
    "where len(list_filter(x, lambda v: v > 0.2)) > 0",
    "bits",
)
def nonzero_rows(spark, sf):
    at = F.filter(F.transform("x", lambda v, i: F.when(v > 0.2, i).otherwise(F.lit(-1))), lambda i: i >= 0)
    rows = features.non_zero(bits(spark, sf).withColumn("on", at), "on")
    return rows.select("id", F.size("on").alias("on_bits"))


@query("vector_bits", "select id, unnest(bits) as bit from bits", "bits")
def vector_bits(spark, sf):
    """On-bits to sparse vectors and back."""
    sparse = features.bits_to_vector(bits(spark, sf).select("id", "bits"), "bits", "v", 64)
    return sparse.select("id", F.explode(features.vector_to_bits(F.col("v"))).alias("bit"))


@query(
    "feature_join",
    "select structures.id, structure, p_size, cast(length(structure) as int) as n_chars from structures join part on p_partkey = id",
    "structures",
)
def feature_join(spark, sf):
    made = structures(spark, sf).select(F.col("id"), "structure", F.length("structure").alias("n_chars"))
    base = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_size")
    return features.join_features(base, made, "id")


@query(
    "valid_first_join",
    """select ord, standard_value, try_cast(standard_value as double) * 2 as doubled from activity_raw
    where try_cast(standard_value as double) is not null""",
    "activity_raw",
)
def valid_first_join(spark, sf):
    """Features of the valid rows only, matched by key whatever the order of the invalid ones."""
    rows = activity_raw(spark, sf).select("ord", "standard_value")
    made = rows.select("ord", (act.to_number(F.col("standard_value")) * 2).alias("doubled")).where("doubled is not null")
    return features.join_features(rows, made, "ord")


@query(
    "feature_job",
    """select id, structure, cast(length(structure) as int) as n_chars, cast(length(structure) - length(replace(structure, 'N', '')) as int) as n_nitrogen
    from structures where structure not like '%.Cl'""",
    "structures",
)
def feature_job(spark, sf):
    """Two functions of a registry; a row in which one fails goes."""

    def one_part(s: str) -> int:
        if "." in s:
            raise ValueError("more than one part")
        return len(s)

    registry = {
        "n_chars": (one_part, "int"),
        "n_nitrogen": (lambda s: s.count("N"), "int"),
        "n_oxygen": (lambda s: s.count("O"), "int"),
    }
    return features.feature_job(structures(spark, sf), "structure", registry, ["n_chars", "n_nitrogen"])


NEAREST = """with q as (select id, list_filter(list_transform(x, lambda v, i: case when v > 0.05 then cast(i - 1 as int) else -1 end),
    lambda b: b >= 0) as asked from bits),
  pairs as (select q.id, t.id as other, len(list_intersect(asked, bits)) as c, len(asked) as a, len(bits) as b from q, bits t),
  scored as (select id, other, c / (a + b - c) as s from pairs where a + b > 0),
  best as (select id, max(s) as s, arg_min(other, (-s, other)) as other from scored where s >= {t} group by id)"""


@query(
    "tanimoto_nearest",
    NEAREST.format(t=0.55)
    + f" select bits.id, other as neighbour, {q6('s')} as similarity, s is not null as in_domain from bits left join best using (id)",
    "bits",
)
def tanimoto_nearest(spark, sf):
    """Nearest on-bit set of the table for the strong bits of every row."""
    rows = bits(spark, sf)
    at = F.filter(F.transform("x", lambda v, i: F.when(v > 0.05, i).otherwise(F.lit(-1))), lambda i: i >= 0)
    found = similarity.nearest_neighbours(rows.select("id", at.alias("bits")), rows.select("id", "bits"), 0.55, 64)
    return rounded(found, "similarity")


@query(
    "tanimoto_nearest_structures",
    f"""with q as (select molecule_id as id, {bits_sql('structure', 2048)} as asked from (select distinct molecule_id, structure from activity_raw)),
    t as (select id, {bits_sql('structure', 2048)} as bits from structures),
    distinct_q as (select distinct asked from q), distinct_t as (select bits, min(id) as other from t group by 1),
    scored as (select asked, other, len(list_intersect(asked, bits)) / (len(asked) + len(bits) - len(list_intersect(asked, bits))) as s
      from distinct_q, distinct_t),
    best as (select asked, max(s) as s, arg_min(other, (-s, other)) as other from scored where s >= 0.6 group by 1)
    select distinct q.id, other as neighbour, {q6('s')} as similarity, s is not null as in_domain from q left join best using (asked)""",
    "activity_raw", "structures",
)
def tanimoto_nearest_structures(spark, sf):
    """The nearest part for every measured structure, by hashed bits."""
    asked = activity_raw(spark, sf).select(
        F.col("molecule_id").alias("id"), st.hashed_bits(F.col("structure")).alias("bits")
    )
    known = structures(spark, sf).select("id", st.hashed_bits(F.col("structure")).alias("bits"))
    return rounded(similarity.nearest_neighbours(asked.distinct(), known, 0.6, 2048), "similarity")


# Vectors.

LONG = "long_rows as (select id, cluster, i - 1 as pos, x[i] as v from bits, unnest(range(1, len(x) + 1)) t(i))"


@query(
    "column_moments",
    f"with {LONG} select cast(pos as int) as pos, {q6('avg(v)')} as mean, {q6('stddev_pop(v)')} as std from long_rows group by pos",
    "bits",
)
def column_moments(spark, sf):
    return rounded(cluster.column_moments(vectors(spark, sf), "features"), "mean", "std")


@query(
    "zscore",
    f"""with {LONG}, m as (select pos, avg(v) as mean, stddev_pop(v) as std from long_rows group by pos)
    select id, cast(pos as int) as pos, {q6('coalesce((v - mean) / nullif(std, 0), 0)')} as z from long_rows join m using (pos)""",
    "bits",
)
def zscore(spark, sf):
    z = cluster.zscore(vectors(spark, sf), "features", "z")
    return z.select("id", F.posexplode("z").alias("pos", "z")).withColumn("z", r6("z"))


CENTRES = f"{LONG}, centres as (select cluster, pos, avg(v) as c from long_rows group by all)"


@query(
    "assign_centres",
    f"""with {CENTRES}, away as (select l.id, c.cluster, sum(pow(v - c, 2)) as d from long_rows l join centres c using (pos) group by all)
    select id, cast(arg_min(cluster, (d, cluster)) as int) as nearest, {q6('sqrt(min(d))')} as distance from away group by id""",
    "bits",
)
def assign_centres(spark, sf):
    rows = vectors(spark, sf)
    centres = cluster.group_centres(rows, "features", "cluster")
    found = cluster.assign_centres(rows, "features", centres, "cluster")
    return rounded(found.select("id", "nearest", "distance"), "distance")


@query(
    "inertia",
    f"with {CENTRES} select {q6('sum(pow(v - c, 2))')} as inertia from long_rows join centres using (cluster, pos)",
    "bits",
)
def inertia(spark, sf):
    return rounded(cluster.inertia(vectors(spark, sf), "features", "cluster"), "inertia")


SILHOUETTE = """with pairs as (select a.id, a.cluster, b.cluster as other, {d} as d from bits a, bits b),
  sums as (select id, cluster, other, sum(d) as total, count(*) as n from pairs group by all),
  ab as (select id, cluster, max(case when other = cluster and n > 1 then total / (n - 1) end) as a,
    min(case when other <> cluster then total / n end) as b from sums group by all),
  scores as (select id, cluster, coalesce((b - a) / nullif(greatest(a, b), 0), 0) as s from ab)"""


@query(
    "silhouette_exact",
    SILHOUETTE.format(d="list_distance(a.x, b.x)") + f" select id, cluster, {q6('s')} as silhouette from scores",
    "bits",
)
def silhouette_exact(spark, sf):
    return rounded(cluster.silhouette_exact(vectors(spark, sf), "id", "features", "cluster"), "silhouette")


@query(
    "silhouette_squared",
    SILHOUETTE.format(d="pow(list_distance(a.x, b.x), 2)") + f" select {q6('avg(s)')} as silhouette from scores",
    "bits",
)
def silhouette_squared(spark, sf):
    score = cluster.silhouette_squared(vectors(spark, sf), "features", "cluster")
    return rounded(spark.createDataFrame([(score,)], "silhouette double"), "silhouette")


@query("kmeans")
def kmeans(spark, sf):
    labelled, _, _ = cluster.kmeans(vectors(spark, sf).drop("cluster"), "features", 5)
    return stats.group_stats(labelled, ["cluster"], "pic50")


@query("attach_label")
def attach_label(spark, sf):
    rows = vectors(spark, sf).drop("cluster")
    _, model, _ = cluster.kmeans(rows, "features", 5)
    return cluster.attach_label(rows.select("id", "features"), model).select("id", "cluster")


@query("k_curve")
def k_curve(spark, sf):
    rows = vectors(spark, sf)
    return cluster.k_curve(rows, "features", 10, key="id")


@query("k_report")
def k_report(spark, sf):
    rows = vectors(spark, sf).where("cluster = 1")
    return cluster.k_report(rows, "features", 10, key="id", measure="euclidean")[1]


@query("subcluster")
def subcluster(spark, sf):
    labelled, _, _ = cluster.subcluster(vectors(spark, sf), "features", 1)
    return stats.group_stats(labelled, ["subcluster"], "pic50")


@query("pca50")
def pca50(spark, sf):
    table, shares = cluster.project(vectors(spark, sf), "features", 50, keep=["id"])
    return table


@query("map2d")
def map2d(spark, sf):
    return cluster.map_2d(vectors(spark, sf), "features", ["id", "pic50", "cluster"])


@query("map_largest")
def map_largest(spark, sf):
    return cluster.map_largest_cluster(vectors(spark, sf), "features", ["id", "pic50", "cluster"])


@query("landscape3d")
def landscape3d(spark, sf):
    return cluster.landscape_3d(vectors(spark, sf), "features", "id", "pic50")

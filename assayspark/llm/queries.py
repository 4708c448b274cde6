"""The registered queries of the operators: each applies one operator, with its production settings, to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from assayspark.llm import byte_bpe, compression_classifier, exact_dedup, katz, near_dedup, passages, perspectives, prefix_trie, quality_rules, source_mix, spelling, token_transducer, warc
from assayspark.llm.common import ORACLES, QUERIES, query, remainder, table
from assayspark.session import new_path

__all__ = ["ORACLES", "QUERIES"]

TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
# Fixed value: the public pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def fitted_ratio(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality_rules.Ratio:
    """Trusted documents are those labelled good."""
    return quality_rules.fit_ratio(docs, table(spark, sf_dir, "labels").where("quality = 1"))


@query("op8_llr_quality")
def llr_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.measure(docs, fitted_ratio(spark, sf_dir, docs)).select("doc_id", "quality.*")


@query(
    "op9_polynomial_dedup",
    r"""with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
    select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
      row_number() over (partition by norm order by doc_id) = 1 as kept, sha256(norm) as text_sha256
    from t window g as (partition by norm)""",
)
def polynomial_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents")).drop("fp", "n_bytes")


def vocabulary() -> byte_bpe.Vocabulary:
    return byte_bpe.load(f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken", PATTERN)


def coded(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document, by its real ids and decoded bytes."""
    known = vocabulary()
    rows = byte_bpe.encode(docs.select("doc_id", "text"), known).drop("text")
    rows = byte_bpe.decode(rows, known)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op10_sentencepiece_bpe")
def sentencepiece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(table(spark, sf_dir, "documents"))


@query("op7_probminhash")
def probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).drop("key")


# The production mixture: sites in four domains by the number in their name, languages by need.
MIX = source_mix.Plan(share=0.8, epochs=2, seed="mix", weights={"domain": {"site0": 2}, "language": {"en": 4, "fr": 2, "de": 2}})


def mix_columns() -> tuple:
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"(\d+)", 1)
    domain = F.when(number == "", "none").otherwise(F.concat(F.lit("site"), (number.cast("long") % 4).cast("string")))
    return domain, F.col("lang"), F.col("source"), F.col("doc_id"), F.col("text")


def _poured(nodes: str, names: str, above: str) -> str:
    over = f"partition by {above}" if above else ""
    ranked = f"{over} order by case when weight > 0 then cap / weight end nulls last, {names}"
    return f"""(select * exclude (used, left_weight, is_full), case when is_full then cap when open_weight > 0
        then (budget - spent) * weight / open_weight else 0 end as given from (
      select *, sum(case when is_full then 0e0 else weight end) over ({over}) as open_weight,
        sum(case when is_full then cap else 0e0 end) over ({over}) as spent from (
        select *, weight > 0 and cap * left_weight <= (budget - used) * weight as is_full from (
          select *, coalesce(sum(cap) over ({ranked} rows between unbounded preceding and 1 preceding), 0e0) as used,
            sum(weight) over ({ranked} rows between current row and unbounded following) as left_weight from {nodes}))))"""


MIX_SQL = f"""with d as (select doc_id, case when regexp_extract(coalesce(source, ''), '(\\d+)', 1) = '' then 'none'
      else 'site' || (regexp_extract(source, '(\\d+)', 1)::bigint % 4) end as domain, lang as language, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as n_tokens from documents),
  leaf as (select domain, language, source, sum(n_tokens)::bigint as tokens from d group by all),
  n1 as (select domain, sum(tokens * 2)::double as cap, case domain when 'site0' then 2e0 else 1e0 end as weight,
    (select floor(sum(tokens) * 0.8e0)::double from leaf) as budget from leaf group by domain),
  g1 as {_poured('n1', 'domain', '')},
  n2 as (select leaf.domain, language, sum(tokens * 2)::double as cap,
    case language when 'en' then 4e0 when 'fr' then 2e0 when 'de' then 2e0 else 1e0 end as weight, any_value(g1.given) as budget
    from leaf join g1 on leaf.domain is not distinct from g1.domain group by leaf.domain, language),
  g2 as {_poured('n2', 'domain, language', 'domain')},
  n3 as (select leaf.*, (tokens * 2)::double as cap, 1e0 as weight, g2.given as budget from leaf join g2
    on leaf.domain is not distinct from g2.domain and leaf.language is not distinct from g2.language),
  g3 as (select *, floor(given)::bigint as target from {_poured('n3', 'domain, language, source', 'domain, language')}),
  e as (select *, case when tokens > 0 then target // tokens else 0 end as whole from g3),
  p as (select d.*, e.target, e.whole, e.target - e.whole * e.tokens as rest,
      md5('mix:' || e.whole || ':' || coalesce(d.doc_id::varchar, '')) as place
    from d join e on d.domain is not distinct from e.domain and d.language is not distinct from e.language and d.source is not distinct from e.source)
  select doc_id, domain, language, source, n_tokens, target as target_tokens, (whole + case when rest > 0
    and sum(n_tokens) over (partition by domain, language, source order by place range unbounded preceding) <= rest then 1 else 0 end)::bigint as copies
  from p"""


@query("op6_hierarchical_mix", MIX_SQL)
def hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.decide(table(spark, sf_dir, "documents"), *mix_columns(), plan=MIX)


@query("op1_compression_classifier")
def compression_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    scored = compression_classifier.score(docs, compression_classifier.fit(docs, labels))
    return scored.select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query(
    "op3_warc",
    """with p as (select page_id, encode(coalesce(html, '')) as b, sha1(encode(coalesce(html, ''))) as h from pages),
    g as (select *, max(page_id) over (partition by b) as first from p)
    select page_id, octet_length(b)::bigint as payload_bytes, list_aggregate(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          1 + ((('0x' || substr(h, 1 + 5 * (i // 4)::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31), 1)), 'string_agg', '') as payload_digest,
      case when first > page_id then 'revisit' else 'response' end as record_type, case when first > page_id then first end as refers_to
    from g""",
)
def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses are judged by the payload read back, revisits by their headers."""
    path = new_path(spark, "warc")
    warc.write(warc.records_of(table(spark, sf_dir, "pages")), path)
    rows = warc.read(spark, path)
    response = F.col("record_type") == "response"
    return rows.select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        F.when(response, F.length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, warc.base32_sha1(F.col("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


@query(
    "op5_perspectives",
    """with m as (select distinct conv_id, turn, role, coalesce(text, '') as text, floor(turn / 64)::bigint as example from conversations),
    s as (select distinct conv_id, role as speaker from conversations where role <> 'system'),
    r as (select m.*, s.speaker, role is not distinct from speaker as mine, replace(text, '<|im_', '< |im_') as safe,
        case when role is not distinct from speaker then '<|im_start|>assistant' || chr(10) when role = 'system' then '<|im_start|>system' || chr(10)
          else '<|im_start|>user name=' || regexp_replace(replace(coalesce(role, 'unknown'), '<|im_', '< |im_'), '\\s+', '_', 'g') || chr(10) end as head
      from m join s on m.conv_id is not distinct from s.conv_id),
    p as (select *, (row_number() over (partition by conv_id, speaker, example order by turn, role, text) - 1) // 4096 as part from r),
    o as (select *, sum(length(head) + length(safe) + 11) over (partition by conv_id, speaker, example, part order by turn, role, text
        rows unbounded preceding) - length(safe) - 11 as start from p)
    select conv_id, speaker, example, part::bigint as part, count(*)::int as n_messages, count(*) filter (mine)::int as n_trained,
      string_agg(head || safe || '<|im_end|>' || chr(10), '' order by turn, role, text) as rendered,
      coalesce(string_agg(start::varchar || '-' || (start + length(safe) + 10)::varchar, ' ' order by turn, role, text) filter (mine), '') as spans
    from o group by conv_id, speaker, example, part""",
)
def rotated_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), " ")
    return perspectives.rotate(table(spark, sf_dir, "conversations")).withColumn("spans", spans)


@query("op2_katz_backoff")
def katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = katz.score(docs, remainder("doc_id", 7) != 2)
    return scored.withColumn("held_out", remainder("doc_id", 7) == 2)


@query("op4_paragraph_minhash")
def paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.find(table(spark, sf_dir, "documents")).drop("row")


# crc32 of a list of bytes, as DuckDB says it: `crc_table` holds the 256 remainders, `crc_sql` folds the bytes over them.
CRC_TABLE = """crc_table as (select list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as crcs)"""


def crc_sql(codes: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255) + 1])), 4294967295)"


@query(
    "op13_prefix_trie",
    f"""with {CRC_TABLE},
    o as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over
      (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos from conversations where conv_id is not null),
    c as (select conv_id, count(*) as n_own, conv_id - conv_id % 5 as base from o group by conv_id),
    h as (select c.*, {crc_sql("list_transform(string_split(conv_id::varchar, ''), lambda x: ord(x)::bigint)")} % 9 as h from c, crc_table),
    l as (select h.*, least(h, coalesce(c.n_own, 0)) as taken from h left join c on c.conv_id = h.base),
    r as (select l.conv_id, pos as depth, role, text from l join o on o.conv_id = base and pos <= taken
      union all select l.conv_id, pos - h + taken, role, text from l join o on o.conv_id = l.conv_id and pos > h),
    p as (select conv_id, depth, text, list({{'role': role, 'text': text}}) over (partition by conv_id order by depth) as path from r),
    e as (select l.conv_id, coalesce(max(depth), 0) as last from l left join r using (conv_id) group by l.conv_id),
    n as (select depth, path, min(conv_id) as conv_id, count(*) as n_convs, any_value(strlen(text)) as size,
        string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = last) as ended from p join e using (conv_id) group by depth, path
      union all select 0, [], min(conv_id), count(*), 0, string_agg(conv_id::varchar, ',' order by conv_id) filter (last = 0) from e having count(*) > 0),
    k as (select path[1:depth - 1] as path, count(*) as n_children from n where depth > 0 group by 1),
    f as (select n.*, coalesce(n_children, 0) as n_children, case when depth > 0 then path[1:depth - 1] end as above from n left join k using (path)),
    a as (select path[1:step] as path, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * size) as saved_tokens
      from (select f.*, unnest(range(0, depth + 1)) as step from f) group by 1)
    select f.conv_id, f.depth::bigint as depth, g.conv_id as parent_conv_id, f.n_convs, f.n_children::bigint as n_children,
      n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, sha256(coalesce(f.ended, '')) as ends_sha256
    from f join a using (path) left join f g on g.path = f.above""",
)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query(
    "op12_spelling_variants",
    f"""with {CRC_TABLE},
    r as (select doc_id, run, count(*) as k from (select doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run from documents)
      where length(run) >= 7 group by all),
    b as (select run, k, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''), lambda x:
      case when ord(x) < 128 then [ord(x)::bigint] else [192 + (ord(x) >> 6), 128 + (ord(x) & 63)]::bigint[] end)) as codes from r),
    h as (select run, k, {crc_sql("codes")} as h from b, crc_table),
    w as (select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word,
      sum(k)::bigint as n from h group by 1 having length(word) >= 7 and sum(k) >= 2),
    d as (select word, n, i, substr(word, 1, i::int - 1) || substr(word, i::int + 1) as cut from (select *, unnest(range(1, length(word) + 1)) as i from w)),
    near as (select a.word, b.word as v, b.n from d a join d b on a.cut = b.cut and a.i = b.i and a.word <> b.word
      union select d.word, w.word, w.n from d join w on d.cut = w.word
      union select w.word, d.word, d.n from d join w on d.cut = w.word),
    f as (select word, count(*) as n_near, min(struct_pack(less := -n, v := v)) as best from near group by word),
    g as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when -best.less >= 10 * w.n then best.v end as form,
      case when -best.less >= 10 * w.n then -best.less end as form_n from w left join f using (word)),
    t as (with recursive up as (select word, word as root, 0 as step from g union all
      select up.word, g.form, step + 1 from up join g on g.word = up.root where g.form is not null)
      select word, arg_max(root, step) as root from up group by word)
    select g.word, form, root, n, n_near::bigint as n_near, form_n::bigint as form_n from g join t using (word)""",
)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    """A vocabulary file in the folder named by TOKENIZERS_DIR or else where the installed package keeps it."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op11_token_transducer")
def transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = token_transducer.count_tokens(docs, token_transducer.load(tokenizer_file("byte_bpe_50k.json")))
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return rows.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))

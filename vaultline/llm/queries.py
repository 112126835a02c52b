"""The registered queries of this package, over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.alignment import align_documents, read_piece_model, score_links
from vaultline.llm.byte_pairs import encode_byte_pairs, load_byte_pairs
from vaultline.llm.crf_quality import fit_field, score_quality
from vaultline.llm.itq_dedup import itq_components
from vaultline.llm.jaccard_join import jaccard_components
from vaultline.llm.kneser_ney import judge_perplexity
from vaultline.llm.longest_match import count_tokens, read_pieces
from vaultline.llm.mixing import mix_sources
from vaultline.llm.piece_matching import encode_documents, load_pieces
from vaultline.llm.tables import table
from vaultline.llm.template_lines import drop_recurring_lines
from vaultline.llm.url_trie import judge_urls
from vaultline.llm.weak_toxicity import score_toxicity
from vaultline.llm.whitening import whiten

# The mix: weights of the tree's nodes; what isn't named has weight 1.
DOMAIN = "concat('domain', coalesce(try_cast(substring(source, 4) as int) % 3, 0))"
DOMAIN_WEIGHTS = {"domain0": 5, "domain1": 3, "domain2": 2}
LANG_WEIGHTS = {"en": 4, "fr": 2, "de": 2, "es": 2}
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 60, 3, 1

RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


# Vocabulary files of public tokenizers.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
PIECE_LIST = "/opt/tokenizers/byte_bpe_50k.tiktoken"
BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"


def _case(column: str, weights: dict[str, int]) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then {w}" for k, w in weights.items()) + " else 1 end"


def mix_weights() -> list:
    return [F.expr(_case("mix_domain", DOMAIN_WEIGHTS)), F.expr(_case("mix_lang", LANG_WEIGHTS)), F.lit(1)]


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix_sources(docs, F.expr(DOMAIN), mix_weights(), MIX_PERCENT, MIX_EPOCHS, MIX_SEED)
    return mixed.select("doc_id", "lang", "source", "epoch", "n_tokens", "taken_tokens")


def _filled_sql(level: str, parents: str, keys: str, weight: str, above: str) -> str:
    """Water-filling of one level in SQL, as in the operator."""
    own = keys.split(", ")[-1]
    part = f"partition by {parents}" if parents else ""
    join = f"join {above} using ({parents})" if parents else f"cross join {above}"
    return f"""
    {level}_nodes as (select {keys}, sum(capacity) as capacity, {weight} as weight from leaves group by {keys}),
    {level}_levels as (
        select n.*, budget,
            (budget - coalesce(sum(capacity) over (o rows between unbounded preceding and 1 preceding), 0))::double
            / (sum(weight) over (o rows between current row and unbounded following))::double as level
        from {level}_nodes n {join}
        window o as ({part} order by capacity::double / weight::double, {own})),
    {level}_budgets as (
        select {keys}, greatest(least(capacity, floor(max(level) over ({part}) * weight)::bigint), 0)::bigint as budget
        from {level}_levels)"""


MIXING_SQL = f"""
with docs as (
    select doc_id, lang, source, 'domain' || coalesce(try_cast(substr(source, 4) as int) % 3, 0) as d,
        coalesce(lang, '') as l, coalesce(source, '') as s,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as tokens
    from documents),
    leaves as (select d, l, s, sum(tokens)::bigint as tokens, sum(tokens)::bigint * {MIX_EPOCHS} as capacity
        from docs group by d, l, s),
    total as (select floor(sum(tokens) * {MIX_PERCENT} / 100)::bigint as budget from leaves),
    {_filled_sql("domain", "", "d", _case("d", DOMAIN_WEIGHTS), "total")},
    {_filled_sql("lang", "d", "d, l", _case("l", LANG_WEIGHTS), "domain_budgets")},
    {_filled_sql("source", "d, l", "d, l, s", "1", "lang_budgets")},
    plan as (select d, l, s, budget // tokens as whole, budget % tokens as rest
        from source_budgets join leaves using (d, l, s) where tokens > 0 and budget > 0),
    placed as (
        select docs.*, whole, rest, coalesce(sum(tokens) over (partition by d, l, s
            order by ('0x' || substr(md5('{MIX_SEED}:' || (whole + 1) || ':' || doc_id), 1, 15))::bigint, doc_id::varchar
            rows between unbounded preceding and 1 preceding), 0)::bigint as before
        from docs join plan using (d, l, s))
select doc_id, lang, source, epoch, tokens as n_tokens, tokens as taken_tokens
from (select *, unnest(range(1, whole + 1)) as epoch from placed)
union all
select doc_id, lang, source, whole + 1, tokens, least(tokens, rest - before) from placed where before < rest
"""


def itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_components(table(spark, sf_dir, "embeddings"), threshold=0.93)


def crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_field(docs, table(spark, sf_dir, "labels")))


def kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_perplexity(table(spark, sf_dir, "documents"))


def weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES)


URL_SQL = f"""
with rests as (
    select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
    from pages),
    parts as (
        select page_id,
            translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
        from rests),
    rules(verdict, rule) as (values {", ".join(str(r) for r in RULES)}),
    found as (
        select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
        from parts join rules on ('.' || host) like ('%.' || split_part(rule, '/', 1))
            and starts_with(path, substr(rule, strpos(rule, '/')))
        group by page_id)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join found using (page_id)
"""


def template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(table(spark, sf_dir, "documents"))


def piece_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), load_pieces(PIECE_MODEL))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=4, percent=85)


def longest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), read_pieces(PIECE_LIST))


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    aligned = align_documents(docs, load_byte_pairs(BYTE_MODEL), read_piece_model(PIECE_MODEL))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return score_links(aligned.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256"))


def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_byte_pairs(table(spark, sf_dir, "documents"), load_byte_pairs(BYTE_MODEL))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": mixing,
    "op2_itq_dedup": itq_dedup,
    "op3_crf_quality": crf_quality,
    "op4_kneser_ney": kneser_ney,
    "op5_weak_toxicity": weak_toxicity,
    "op6_url_trie": url_trie,
    "op7_template_lines": template_lines,
    "op8_piece_matching": piece_matching,
    "op9_jaccard_join": jaccard_join,
    "op10_longest_match": longest_match,
    "op11_alignment": alignment,
    "op12_whitening": whitening,
    "op13_byte_pairs": byte_pairs,
}

ORACLES: dict[str, str] = {"op1_mixing": MIXING_SQL, "op6_url_trie": URL_SQL}

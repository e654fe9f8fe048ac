"""The operators applied to the given tables, each over the whole of them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import chat, collocations, html_text, order_minhash, packing, pii, quality, ranked_search, shards, tiling, token_files, toxicity, url_reputation
from skyledger.llm.common import scratch, stored, table


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all documents."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op3_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, with terms that disclose it."""
    found = pii.spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op4_range_coded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as entropy-coded ids, read back from the files."""
    folder = scratch(spark, "token-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    token_files.write(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    return shards.shard(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), 24)


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1,024 ids, read back from the sequences."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.places(stored(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2), "sequences"))


def op7_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that leak into documents, for all documents."""
    return tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_likelihood_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the ratio of trusted to raw n-grams for all documents."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_spliced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings, assembled and read back."""
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return chat.read_back(chat.assemble(turns, path), path)


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of all documents."""
    return order_minhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "kept")


def op11_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of all pages, by rules or the reputation of their host."""
    return url_reputation.judge(table(spark, sf_dir, "pages"))


def op12_automaton_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents for every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_rollup_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kneser_ney": op1_kneser_ney,
    "op2_text_density": op2_text_density,
    "op3_disclosure": op3_disclosure,
    "op4_range_coded_ids": op4_range_coded_ids,
    "op5_kd_shards": op5_kd_shards,
    "op6_best_fit": op6_best_fit,
    "op7_string_tiling": op7_string_tiling,
    "op8_likelihood_ratio": op8_likelihood_ratio,
    "op9_spliced_chat": op9_spliced_chat,
    "op10_order_minhash": op10_order_minhash,
    "op11_host_reputation": op11_host_reputation,
    "op12_automaton_search": op12_automaton_search,
    "op13_rollup_collocations": op13_rollup_collocations,
}

_SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rule_case(value: Callable[[url_reputation.Rule], str]) -> str:
    whens = []
    for rule in sorted(url_reputation.RULES, key=lambda r: -len(r.pattern)):
        host, slash, path = rule.pattern.partition("/")
        whens.append(f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{slash}{path}') then '{value(rule)}'")
    return f"case {' '.join(whens)} end"


def _prior(groups: str) -> str:
    """The weight of the prior over groups with labelled n, blocked k and the parent's mean p."""
    return f"""
        select (1 - rho) / rho as weight from (select least(greatest(coalesce(
          sum(case when n > 1 then ((k - n * p) * (k - n * p) - (k * (1 - p) * (1 - p) + (n - k) * p * p)) / (n - 1) end)
          / nullif(sum(case when n > 1 then n * p * (1 - p) end), 0), 0.5::double), {url_reputation.LEAST}::double), {url_reputation.MOST}::double) as rho
        from {groups})"""


_SECOND = ", ".join(f"'{label}'" for label in url_reputation.COUNTRY_SECOND)
_OP11 = f"""
    with rest as (
      select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
    parts as (
      select page_id, {_SMALL.format("regexp_extract(rest, '^[^/?#]*')")} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rest),
    ruled as (
      select *, {_rule_case(lambda r: r.pattern)} as rule, {_rule_case(lambda r: r.verdict)} as ruled,
        regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as site from parts),
    labels as (select *, string_split(site, '.') as l from ruled),
    sized as (
      select *, case when len(l) >= 3 and length(l[len(l)]) = 2 and l[len(l) - 1] in ({_SECOND}) then 2 else 1 end as size,
        regexp_matches(site, '^[0-9.]*$') or starts_with(site, '[') as number from labels),
    sites_of as (
      select *, case when number or len(l) <= size then site else array_to_string(l[len(l) - size:], '.') end as domain,
        case when number then '' else array_to_string(l[len(l) - size + 1:], '.') end as suffix from sized),
    s as (
      select site, domain, suffix, count(ruled) as labelled, count(*) filter (ruled = 'block') as blocked,
        count(ruled)::double as n, (count(*) filter (ruled = 'block'))::double as k from sites_of group by all),
    d as (select domain, suffix, sum(n) as n, sum(k) as k from s group by all),
    x as (select suffix, sum(n) as n, sum(k) as k from d group by all),
    x0 as (select *, ((select sum(k) from x) + 1) / ((select sum(n) from x) + 2) as p from x),
    x1 as (select suffix, (k + weight * p) / (n + weight) as mean from x0, ({_prior("x0")})),
    d0 as (select d.*, mean as p from d join x1 using (suffix)),
    d1 as (select domain, (k + weight * p) / (n + weight) as mean from d0, ({_prior("d0")})),
    s0 as (select s.*, mean as p from s join d1 using (domain)),
    s1 as (select site, labelled, blocked, (k + weight * p) as up, (n - k + weight * (1 - p)) as down from s0, ({_prior("s0")})),
    s2 as (select *, up / (up + down) as mean from s1),
    s3 as (select *, mean - {url_reputation.Z}::double * sqrt(mean * (1 - mean) / (up + down + 1)) as bound from s2)
    select page_id, host, path, rule, coalesce(ruled, case when bound >= {url_reputation.LIMIT} then 'block' else 'allow' end) as verdict,
      s3.labelled, s3.blocked, round(mean, 6) as mean, round(bound, 6) as bound
    from sites_of join s3 using (site)"""

_TERMS = rf"regexp_extract_all({_SMALL.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_OP12 = f"""
    with d as (select row_number() over () as r, doc_id, {_TERMS} as terms from documents),
    tokens as (select r, doc_id, unnest(terms) as term from d),
    corpus as (select count(distinct r) as n_docs, count(*) as n_terms from tokens),
    lengths as (select r, count(*) as n from tokens group by r),
    b as (select row_number() over () as i, item_id, {_TERMS} as terms from benchmark),
    wanted as (select i, item_id, term, count(*) as times from (select i, item_id, unnest(terms) as term from b) group by all),
    tf as (select r, doc_id, term, count(*) as tf from tokens where term in (select term from wanted) group by all),
    w as (
      select term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double)) as bigint) as w
      from (select term, count(*) as df from tf group by term), corpus),
    part as (
      select r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) as part
      from tf join w using (term) join lengths using (r), corpus),
    scores as (select i, item_id, r, doc_id, cast(sum(times * part) as bigint) as score from wanted join part using (term) group by all)
    select item_id, cast(rank as integer) as rank, doc_id, score from (
      select *, row_number() over (partition by i order by score desc, doc_id nulls last) as rank from scores where score > 0)
    where rank <= {ranked_search.TOP}"""

_OP13 = rf"""
    with t as (select coalesce(lang, '{collocations.NO_LANG}') as lang, {_SMALL.format("coalesce(text, '')")} as text from documents),
    p as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?
-
]')) as piece from t),
    a as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as words from p),
    i as (select lang, unnest(words) as x, unnest(words[2:]) as y, unnest(words[3:]) as z from a),
    f as (
      select lang, 1 as k, x as phrase, count(*) as n from i group by all
      union all select lang, 2, x || ' ' || y, count(*) from i where y is not null group by all
      union all select lang, 3, x || ' ' || y || ' ' || z, count(*) from i where z is not null group by all),
    keyed as (select lang || chr(9) || phrase as key, n from f),
    totals as (select lang, cast(sum(n) as bigint) as n from f where k = 1 group by lang),
    c as (select lang, k, phrase, n as a, string_split(phrase, ' ') as words from f where k > 1 and n >= {collocations.LEAST}),
    cuts as (
      select lang, phrase, a, cut, array_to_string(words[:cut], ' ') as first, array_to_string(words[cut + 1 :], ' ') as rest
      from c, (values (1), (2)) cuts(cut) where cut < k),
    scored as (
      select cuts.*, l.n as l, r.n as r, cast((1000000::hugeint * a * a) // (l.n::hugeint * r.n) as bigint) as score
      from cuts join keyed l on l.key = cuts.lang || chr(9) || first join keyed r on r.key = cuts.lang || chr(9) || rest),
    best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
    longer as (
      select lang, part, max(a) as longest
      from (select lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) as part from c where k = 3) group by all),
    kept as (
      select best.* from best left join longer on longer.lang = best.lang and part = phrase
      where longest is null or 100 * longest < {collocations.INSIDE} * a)
    select lang, rank, phrase, a, l, r, n, score from (
      select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept) join totals using (lang)
    where rank <= {collocations.TOP}"""
SQL: dict[str, str] = {"op11_host_reputation": _OP11, "op12_automaton_search": _OP12, "op13_rollup_collocations": _OP13}

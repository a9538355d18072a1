"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.llm import chat, secrets
from shiftledger.llm.exact_dedup import exact_copies
from shiftledger.llm.host_rules import judge
from shiftledger.llm.manifest import verified_documents
from shiftledger.llm.mixing import with_copies
from shiftledger.llm.near_join import near_copies
from shiftledger.llm.packing import pack
from shiftledger.llm.pii import with_surrogates
from shiftledger.llm.quality import quality_scores
from shiftledger.llm.ranked import ranked
from shiftledger.llm.token_counts import token_counts
from shiftledger.llm.toxicity import toxic_passages

SURROGATE_KEY = "registered query"  # in production a secret of the caller

Build = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxic_passages(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return with_surrogates(docs, SURROGATE_KEY)


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_copies(table(spark, folder, "documents"))


OP5_SQL = """
    with hashed as (
        select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
            as text_sha256
        from documents)
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
        doc_id = max(doc_id) over same as kept, text_sha256
    from hashed window same as (partition by text_sha256)"""


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, folder, "documents")))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_path())


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    held = "conv_id long, turn long, role string, text string"
    marked = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", marked), (-1, 1, "assistant", marked)], held)
    messages = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.read_back(chat.format_turns(messages))


def _escaped_sql(column: str) -> str:
    held = f"replace({column}, '\\', '\\\\')"
    for control in chat.CONTROLS:
        held = f"replace({held}, '{control}', '{control[0]}\\{control[1:]}')"
    return held


OP8_SQL = f"""
    with every as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
    said as (select *, {_escaped_sql("role")} as head, {_escaped_sql("text")} as body from every)
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, head, body)) as turns_sha256,
        coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn nulls first, head, body) filter (role = 'assistant'), '')) as loss_sha256,
        sum(length(head) + length(body) + {len(chat.TURN + chat.SAYS + chat.OVER)})::bigint as formatted_chars
    from said group by conv_id"""


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return with_copies(docs).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
    )


OP9_SQL = r"""
    with sized as (
        select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
            (('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), 'text ' || md5(coalesce(text, '')))), 1, 13))::bigint
                + 0.5::double) / 4503599627370496::double as u
        from documents),
    rated as (select *, case when size < 50 then 1 else 2 end as intensity from sized),
    levels as (select source, intensity, sum(size)::bigint as level_size from rated group by all),
    sources as (select source, sum(level_size)::bigint as source_size from levels group by all),
    weighted as (
        select *, [5, 2, 1][(row_number() over (order by encode(source) nulls last) - 1) % 3 + 1] as weight,
            3 * source_size as cap, sum(source_size) over () as all_size
        from sources),
    tried as (
        select *, all_size::double - coalesce(sum(cap) over (order by cap / nullif(weight, 0) nulls first, encode(source) nulls last
                rows between unbounded preceding and 1 preceding), 0)::double as rest_size,
            (sum(weight) over (order by cap / nullif(weight, 0) nulls first, encode(source) nulls last
                rows between current row and unbounded following))::double as rest
        from weighted),
    told as (select *, rest_size * weight > cap * rest as is_full from tried),
    targets as (
        select source, source_size, case when is_full then cap::double
            else (arg_max(rest_size / rest, rest) filter (not is_full) over ()) * weight end as target
        from told),
    of_level as (
        select l.*, t.source_size, t.target, 3 * level_size as cap, level_size * intensity as weight
        from levels l join targets t on l.source is not distinct from t.source),
    tried_level as (
        select *, target - coalesce(sum(cap) over (partition by source order by cap / nullif(weight, 0) nulls first, intensity
                rows between unbounded preceding and 1 preceding), 0)::double as rest_size,
            (sum(weight) over (partition by source order by cap / nullif(weight, 0) nulls first, intensity
                rows between current row and unbounded following))::double as rest
        from of_level),
    told_level as (select *, coalesce(rest_size * weight > cap * rest, true) or weight = 0 as is_full from tried_level),
    expected as (
        select *, case when is_full then 3.0::double else least(
            (arg_max(rest_size / rest, rest) filter (not is_full) over (partition by source)) * intensity, 3.0::double) end as copies
        from told_level),
    ranked as (
        select r.doc_id, r.source, r.size, e.source_size, e.target, floor(e.copies) as certain,
            e.target - (select sum(floor(x.copies) * x.level_size) from expected x
                where x.source is not distinct from e.source) as rest_size,
            case when e.copies - floor(e.copies) > 0 then
                u * (1 - (e.copies - floor(e.copies))) / ((1 - u) * (e.copies - floor(e.copies))) end as odds
        from rated r join expected e on r.source is not distinct from e.source and r.intensity = e.intensity)
    select doc_id, size::bigint as size, source_size, target,
        ((certain + case when odds is not null and sum(case when odds is not null then size else 0 end)
            over (partition by source order by odds nulls last, doc_id nulls first rows between unbounded preceding and current row)
            - size / 2 <= rest_size then 1 else 0 end) * size)::bigint as taken
    from ranked"""


def op10_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"))


OP10_SQL = r"""
    with split as (
        select doc_id, source, coalesce(text, '') as text,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
            [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as lines
        from documents),
    windows as (
        select doc_id, pos, words[pos] || ' ' || words[pos + 1] || ' ' || words[pos + 2] as window_text
        from (select doc_id, words, unnest(range(1, len(words) - 1)) as pos from split)),
    again as (select doc_id, pos from windows qualify count(*) over (partition by doc_id, window_text) > 1),
    covered as (
        select doc_id, count(distinct place) as n_repeat_words
        from (select doc_id, unnest([pos, pos + 1, pos + 2]) as place from again) group by doc_id),
    measured as (
        select s.doc_id, source, len(words)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint
                as word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(lines) as n_lines,
            (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
        from split s left join covered c on s.doc_id = c.doc_id),
    ruled as (
        select *, n_words < 50 as few_words, 100 * n_repeat_words > 50 * n_words as repeats, 10 * n_symbols > 3 * n_words as symbols,
            10 * n_dup_lines > 3 * n_lines as dull
        from measured),
    counted as (
        select source, rule, count(*) as n, count(*) filter (failed) as k
        from (
            select source, 'few_words' as rule, few_words as failed from ruled
            union all select source, 'repeats', repeats from ruled
            union all select source, 'symbols', symbols from ruled
            union all select source, 'lines', dull from ruled)
        group by all),
    spread as (
        select *, sum(k) over every / sum(n) over every as mean, sum(k * k / n) over every / sum(n) over every as squares
        from counted window every as (partition by rule)),
    weighed as (
        select *, case when squares - mean * mean > 1e-12
            then least(greatest(mean * (1 - mean) / (squares - mean * mean) - 1, 2), 1000) else 1000 end as prior
        from spread),
    hosts as (
        select source, bool_or((k + mean * prior) / (n + prior) > 0.5) as host_failed from weighed group by source)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words or repeats as base_failed, host_failed,
        not (few_words or repeats) and not host_failed as kept
    from ruled r join hosts h on r.source is not distinct from h.source"""


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return verified_documents(table(spark, folder, "documents"), tampered)


def _field_sql(column: str) -> str:
    return f"coalesce(strlen({column}::varchar) || ':' || {column}, '-')"


def _levels_sql(name: str, leaves: str) -> str:
    """All nodes over ``leaves`` (tree, idx, digest, n): pairs become one until a level has a single node."""
    return f"""{name} as (
        select tree, 0 as level, idx, digest, n from {leaves}
        union all
        select tree, level + 1, idx // 2, sha256(string_agg(digest, '' order by idx)), (max(n) + 1) // 2
        from {name} where n > 1 group by tree, level, idx // 2)"""


def _folds_sql(name: str, first: str, nodes: str) -> str:
    """Digests of ``first`` (row_id, tree, idx, n, digest, proof) taken up through ``nodes``, with the siblings that were met."""
    return f"""{name} as (
        select row_id, tree, 0 as level, idx, n, digest, proof from {first}
        union all
        select f.row_id, f.tree, f.level + 1, f.idx // 2, (f.n + 1) // 2,
            sha256(case when f.idx % 2 = 0 then f.digest || coalesce(s.digest, '') else s.digest || f.digest end),
            f.proof || coalesce(s.digest, '')
        from {name} f left join {nodes} s on s.tree = f.tree and s.level = f.level and s.idx = xor(f.idx, 1)
        where f.n > 1)"""


def _leaf_sql(count: str) -> str:
    return " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", count, "text"))


OP11_SQL = f"""
    with recursive marked as materialized (
        select row_number() over () as row_id, doc_id, coalesce('=' || lang, '-') as tree,
            sha256({_leaf_sql("n_chars")}) as leaf, sha256({_leaf_sql("(n_chars + 1)")}) as other,
            coalesce(xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
                lambda held, byte: list_reduce(
                    list_prepend(xor(held, byte), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                    lambda x, z: xor(x >> 1, (x & 1) * 3988292384)))) % 7 = 0, false) as tampered
        from documents),
    leaves as materialized (
        select row_id, tree, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx, leaf as digest,
            count(*) over (partition by tree) as n
        from marked),
    {_levels_sql("nodes", "leaves")},
    roots as materialized (
        select '' as tree, tree as name, digest, row_number() over (order by tree) - 1 as idx, count(*) over () as n
        from nodes where n = 1),
    {_levels_sql("forest", "roots")},
    firsts as materialized (
        select l.row_id, l.tree, l.idx, l.n, case when tampered then other else leaf end as digest, '' as proof
        from leaves l join marked using (row_id)),
    {_folds_sql("folds", "firsts", "nodes")},
    seconds as materialized (
        select f.row_id, '' as tree, r.idx, r.n, f.digest, f.proof, r.digest as subroot
        from folds f join roots r on r.name = f.tree where f.n = 1),
    {_folds_sql("tops", "seconds", "forest")}
    select doc_id, leaf, subroot, r.digest as root, sha256(t.proof) as proof_sha256, t.digest as folded_root, t.digest = r.digest as verified
    from tops t join seconds s using (row_id) join marked m using (row_id), forest r
    where t.n = 1 and r.n = 1"""


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("rescored")


OP12_SQL = r"""
    with held as materialized (
        select doc_id, term, count(*) as tf
        from (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents)
        group by all),
    sizes as materialized (select doc_id, sum(tf)::bigint as n from held group by all),
    corpus as materialized (select count(*) as docs, sum(n)::bigint as terms from sizes),
    weights as materialized (
        select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w from held, corpus group by term),
    norms as materialized (select doc_id, (50 + (50 * n * docs) // terms)::bigint as m from sizes, corpus),
    asked as materialized (
        select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
    scored as (
        select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
        from asked join held using (term) join weights using (term) join norms using (doc_id) group by all)
    select item_id, (row_number() over best)::int as rank, doc_id, score from scored where score > 0
    window best as (partition by item_id order by score desc, doc_id) qualify row_number() over best <= 50"""


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


QUERIES: dict[str, Build] = {
    "op1_near_join": op1_near_join,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_pii": op4_pii,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_secrets": op6_secrets,
    "op7_packing": op7_packing,
    "op8_chat": op8_chat,
    "op9_mixing": op9_mixing,
    "op10_host_rules": op10_host_rules,
    "op11_manifest": op11_manifest,
    "op12_ranked_search": op12_ranked_search,
    "op13_token_counts": op13_token_counts,
}

ORACLES: dict[str, str] = {
    "op5_exact_dedup": OP5_SQL,
    "op8_chat": OP8_SQL,
    "op9_mixing": OP9_SQL,
    "op10_host_rules": OP10_SQL,
    "op11_manifest": OP11_SQL,
    "op12_ranked_search": OP12_SQL,
}

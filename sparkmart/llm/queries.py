"""The registered queries of this subpackage, with SQL twins where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import table
from sparkmart.llm.decontamination import contaminated
from sparkmart.llm.language_model import score_documents as language_model_scores
from sparkmart.llm.line_dedup import kept_digests
from sparkmart.llm.mixing import MOST_COPIES, ONE, SEED, WEIGHTS, plan_mix
from sparkmart.llm.near_duplicates import near_duplicates
from sparkmart.llm.packing import pack
from sparkmart.llm.periodic_runs import periodic_runs, planted
from sparkmart.llm.quality import score_documents as quality_scores
from sparkmart.llm.quality_rules import apply_rules
from sparkmart.llm.sharding import SHARDS, SLOTS, write_shards
from sparkmart.llm.toxicity import score_documents as toxicity_scores
from sparkmart.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, vector_codes
from sparkmart.llm.warc import FIRST_CAPTURE, archive_pages

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


_BASE32 = """
array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + cast((('0x' || substr(sha, 1 + 5 * (i // 4), 5))::int >> (15 - 5 * (i % 4))) & 31 as int),
        1)), '')
"""
OP1 = f"""
with payloads as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as sha,
        regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)', ['host', 'rest']) as p
    from pages
),
firsts as (select payload, min(page_id) as first from payloads group by payload),
keyed as (
    select p.*, first,
        array_to_string(list_reverse(string_split(
            regexp_replace(lower(p['host']), '^www[.]', ''), '.')), ',')
        || ')' || case when p['rest'] = '' then '/' else p['rest'] end as url_key
    from payloads p join firsts f on p.payload = f.payload
)
select page_id, cast(strlen(payload) as bigint) as payload_bytes, {_BASE32} as payload_digest,
    case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to,
    url_key, {FIRST_CAPTURE} + page_id as captured_at,
    row_number() over (order by url_key, page_id) - 1 as index_position
from keyed
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = write_shards(table(spark, sf_dir, "documents"), "doc_id")
    return sharded.select("doc_id", "source", "n_chars", "shard_slot", "shard")


OP7 = f"""
with recursive
shards as (
    select unnest({list(SHARDS)}) as shard, unnest(range({len(SHARDS)})) as turn
),
walks as (
    select list(start order by turn) as starts, list(skip order by turn) as skips
    from (select turn,
            ('0x' || substr(md5(shard || '/offset'), 1, 15))::bigint % {SLOTS} as start,
            ('0x' || substr(md5(shard || '/skip'), 1, 15))::bigint % {SLOTS - 1} + 1 as skip
          from shards)
),
claims as (
    select -1 as turn, cast(null as bigint) as slot, list_transform(range({SLOTS}), lambda x: false) as taken
    from walks
    union all
    select turn + 1, slot, list_transform(range({SLOTS}), lambda x: taken[x + 1] or x = slot)
    from (
        select c.turn, c.taken,
            list_filter(
                list_transform(range({SLOTS}), lambda j:
                    (starts[1 + (c.turn + 1) % {len(SHARDS)}]
                     + j * skips[1 + (c.turn + 1) % {len(SHARDS)}]) % {SLOTS}),
                lambda x: not c.taken[x + 1])[1] as slot
        from claims c, walks where c.turn + 1 < {SLOTS}
    )
)
select d.doc_id, d.source, d.n_chars, cast(c.slot as integer) as shard_slot, s.shard
from documents d
join claims c on c.slot =
    ('0x' || substr(md5(coalesce(cast(d.doc_id as varchar), '')), 1, 15))::bigint % {SLOTS}
join shards s on s.turn = c.turn % {len(SHARDS)}
"""


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_digests(table(spark, sf_dir, "documents"))


OP8 = f"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
    from documents
),
keyed as (
    select *, regexp_replace({_LOWER.replace("text", "line")},
        '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') as key
    from lines
),
repeated as (
    select key, max(doc_id) as keeper from keyed where length(key) >= 20
    group by key having count(distinct doc_id) >= 3
),
marked as (
    select k.*, r.key is not null and k.doc_id <> r.keeper as dropped
    from keyed k left join repeated r on k.key = r.key
)
select doc_id, count(*) as n_lines,
       cast(sum(case when dropped then 1 else 0 end) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not dropped), ''))
           as kept_sha256
from marked group by doc_id
"""


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP9 = f"""
with recursive
worded as (
    select doc_id, {_WORDS.format("coalesce(" + _LOWER + ", '')")} as w from documents
),
shingled as (
    select doc_id, list_distinct(
        case when len(w) = 0 then []
             when len(w) < 5 then [array_to_string(w, ' ')]
             else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
        end) as s
    from worded
),
flat as (select doc_id, len(s) as n, unnest(s) as g from shingled),
links as (
    select a.doc_id as x, b.doc_id as y
    from flat a join flat b on a.g = b.g and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n
    having 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach(doc_id, other) as (
    select doc_id, doc_id from shingled
    union
    select r.doc_id, l.y from reach r join links l on r.other = l.x
),
lowest as (select doc_id, min(other) as component_id from reach group by doc_id)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, l.component_id,
       s.doc_id = l.component_id as kept
from shingled s join lowest l on s.doc_id = l.doc_id
"""

def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _op11() -> str:
    """Rounds as a chain of subqueries: points by part, entries as lists of whole numbers."""
    apart = "list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - c.v[i]) ** 2))"

    def nearest(books: str) -> str:
        return f"""
            select vec_id, row, part, v, entry, apart from (
                select p.*, c.entry, cast({apart} as bigint) as apart,
                    row_number() over (partition by p.row, p.part order by {apart}, c.entry) as place
                from points p join {books} c on p.part = c.part)
            where place = 1"""

    steps = [
        f"""kept as (
            select vec_id, label, row_number() over (order by vec_id nulls last) as row,
                list_transform(embedding, lambda x: cast(floor({SCALE} * x::double) as bigint)) as v
            from embeddings
            where embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""points as materialized (
            select vec_id, row, part, v[1 + part * len(v) // {PARTS} : (part + 1) * len(v) // {PARTS}] as v
            from kept, (select unnest(range({PARTS})) as part))""",
        f"""books0 as materialized (
            select part, row - 1 as entry, v from points where row <= {ENTRIES})""",
    ]
    for turn in range(ROUNDS):
        steps.append(f"near{turn} as materialized ({nearest(f'books{turn}')})")
        steps.append(f"""means{turn} as (
            select part, entry, list(mean order by place) as v from (
                select part, entry, place,
                    (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as mean
                from (select part, entry, unnest(v) as x, generate_subscripts(v, 1) as place from near{turn})
                group by part, entry, place)
            group by part, entry)""")
        steps.append(f"""books{turn + 1} as materialized (
            select b.part, b.entry, cast(coalesce(m.v, b.v) as bigint[]) as v
            from books{turn} b left join means{turn} m on b.part = m.part and b.entry = m.entry)""")
    steps.append(f"near{ROUNDS} as materialized ({nearest(f'books{ROUNDS}')})")
    steps.append(f"""coded as (
        select row, string_agg(printf('%02x', entry), '' order by part) as code,
            cast(sum(apart) as bigint) as error
        from near{ROUNDS} group by row)""")
    return f"""
with {", ".join(steps)}
select k.vec_id, c.code, c.error,
    cast(sum(c.error) over (partition by k.label) as bigint) as label_error,
    (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) from books{ROUNDS})
        as codebooks_sha256
from kept k join coded c on k.row = c.row
"""


OP11 = _op11()


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_mix(table(spark, sf_dir, "documents"))
    return plan.withColumn("taken", F.col("copies") * F.col("size"))


OP12 = f"""
with sized as (
    select doc_id, len({_WORDS.format("coalesce(text, '')")}) as size,
        coalesce('0' || source, '1') as source_key
    from documents
),
sources as (
    select source_key, sum(size)::bigint as source_size,
        {list(WEIGHTS)}[1 + (row_number() over (order by source_key) - 1) % {len(WEIGHTS)}] as weight
    from sized group by source_key
),
bounded as (
    select *, ({MOST_COPIES} * source_size)::double / weight as ratio from sources
),
levels as (
    select *, (sum(source_size) over ()
            - coalesce(sum({MOST_COPIES} * source_size) over earlier, 0))::double
        / (sum(weight) over () - coalesce(sum(weight) over earlier, 0))::double as level
    from bounded
    window earlier as (order by ratio, source_key rows between unbounded preceding and 1 preceding)
),
targets as (
    select source_key, source_size, least((3 * source_size)::double, weight
        * (select arg_min(level, (ratio, source_key)) from levels where ratio >= level)) as target
    from levels
),
rated as (
    select *, case when source_size > 0 then round(target / source_size * {ONE})::bigint else 0 end
        as expected,
        ('0x' || substr(md5('{SEED}/' || source_key), 1, 7))::bigint * {ONE >> 28} as start
    from targets
),
summed as (
    select s.doc_id, s.size, r.*, row_number() over (
        partition by s.source_key order by s.size, md5(coalesce(s.doc_id::varchar, ''))) as place
    from sized s join rated r on s.source_key = r.source_key
)
select doc_id, size, source_size, target,
    cast((start + place::hugeint * expected) // {ONE} - (start + (place - 1)::hugeint * expected) // {ONE}
        as bigint) as copies,
    copies * size as taken
from summed
"""


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), arrange=planted)


QUERIES = {
    "op3_lm_scoring": op3_lm_scoring,
    "op1_warc_index": op1_warc_index,
    "op6_quality_rules": op6_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op7_sharding": op7_sharding,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op4_quality_classifier": op4_quality_classifier,
    "op8_line_dedup": op8_line_dedup,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_vector_codes": op11_vector_codes,
    "op12_source_mixing": op12_source_mixing,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {
    "op1_warc_index": OP1,
    "op7_sharding": OP7,
    "op8_line_dedup": OP8,
    "op9_minhash_near_dedup": OP9,
    "op11_vector_codes": OP11,
    "op12_source_mixing": OP12,
}

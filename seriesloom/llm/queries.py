"""The registered queries ``opN_<name>`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact, langid, lexical, media, minhash, mixing, pii, quality, resample, sharding, tokens, urls
from .common import table

#: Host, path and verdict of the registered query's rules.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


#: Bytes at a payload's end whose checksum ``op1`` returns.
TAIL_BYTES = 32

#: Vocabulary files, found where the package of public tokenizers lies.
WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media.written_features(table(spark, sf_dir, "documents"), tail=TAIL_BYTES)
    digests = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    return read.select("doc_id", "n_bytes", *digests, media.tiles_digest(F.col("tiles")).alias("tiles_sha256"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    plain = F.filter("spans", lambda s: ~s["disguised"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(plain, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(plain), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), (F.size("spans") - F.size(plain)).cast("long").alias("n_disguised"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_counts(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    made = bpe.round_trip(docs, vocabulary(WORD_BPE))
    return made.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary(PIECE_BPE))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict_languages(docs, langid.fit(docs))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_media, op2_quality, op3_url_filter, op4_personal_data, op5_mix, op6_bpe, op7_exact_dedup, op8_near_dedup, op9_shards, op10_token_counts, op11_language, op12_search, op13_resample)
}


def _runs(text: str, held: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '{held}+')"


_TERMS, _WORDS, _FEATURES = (_runs("text", held) for held in (r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[^\x20\x09-\x0D]", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"))


_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)

#: The same results as DuckDB SQL; near duplicates from all texts that share a shingle. Media, compression, deobfuscation, BPE,
#: op9's hash, pieces and models of letters have no SQL; their tests compare them with brute force or the libraries.
ORACLES: dict[str, str] = {
    "op3_url_filter": rf"""with rest as (
  select page_id, row_number() over () as n, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
 parts as (
  select *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path from rest),
 judged as (
  select page_id, host, path, h || p as rule, v, row_number() over (partition by n order by length(h || p) desc nulls last) as k
  from parts left join (values {_RULES}) r(h, p, v)
    on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select page_id, host, path, rule, coalesce(v, '{urls.DEFAULT}') as verdict from judged where k = 1""",
    "op5_mix": rf"""with rows as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    ('0x' || substr(md5('17:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 15))::bigint as place
  from documents),
 sources as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as nth from rows group by source),
 caps as (select *, [{", ".join(map(str, mixing.WEIGHTS))}][nth % {len(mixing.WEIGHTS)} + 1] as w, source_size * {mixing.EPOCHS} as cap from sources),
 levels as (
  select *, (sum(source_size) over () * {mixing.SHARE}::double - coalesce(sum(cap) over before, 0))
      / (sum(w) over () - coalesce(sum(w) over before, 0)) as here
  from caps window before as (order by cap::double / w, nth rows between unbounded preceding and 1 preceding)),
 level as (select arg_min(here, (cap::double / w, nth)) as level from levels where here * w < cap),
 targets as (select source as s, source_size, least(cap::double, coalesce(level * w, cap::double)) as target from levels, level),
 goals as (select *, case when source_size = 0 then 0 when target >= 2 * source_size then 2 when target >= source_size then 1 else 0 end as whole
  from targets),
 ordered as (
  select rows.*, source_size, target, whole, target - whole * source_size as goal,
    sum(size) over (partition by source order by place rows unbounded preceding) as after
  from rows join goals on source is not distinct from s)
select doc_id, size, source_size, target,
  (size * (whole + case when after <= goal or (after - size <= goal and abs(after - goal) < abs(after - size - goal)) then 1 else 0 end))::bigint as taken
from ordered""",
    "op7_exact_dedup": r"""with rows as (
  select doc_id, coalesce(text, '') as text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as kept_text from documents)
select doc_id, first_value(doc_id) over best as keep_id, count(*) over (partition by kept_text) as group_size,
  row_number() over best = 1 as kept, sha256(kept_text) as text_sha256
from rows window best as (partition by kept_text order by length(text) desc, doc_id nulls last rows between unbounded preceding and unbounded following)""",
    "op8_near_dedup": rf"""with recursive split as (
  select row_number() over () as r, doc_id, {_WORDS} as words from documents),
 placed as (select r, unnest(words) as word, generate_subscripts(words, 1) as k, len(words) as many from split),
 runs as (
  select r, k, many, concat_ws(' ', word, lead(word, 1) over near, lead(word, 2) over near, lead(word, 3) over near, lead(word, 4) over near) as shingle
  from placed window near as (partition by r order by k)),
 held as (select distinct r, shingle from runs where k <= greatest(many - 4, 1)),
 sets as (select r, count(*) as n, sha256(string_agg(shingle, chr(10) order by shingle)) as class from held group by r),
 keyed as (select r, doc_id, coalesce(n, 0) as n, coalesce(class, 'row ' || r) as class from split left join sets using (r)),
 classes as (select class, min(r) as r, any_value(n) as n, min(doc_id) as least from keyed group by class),
 posts as (select class, n, shingle from classes join held using (r)),
 links as (
  select a.class as one, b.class as other from posts a join posts b on a.shingle = b.shingle
    and a.class <> b.class and 4 * a.n >= 3 * b.n and 4 * b.n >= 3 * a.n
  group by a.class, b.class, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
 reach as (
  select class, least from classes
  union select other, reach.least from reach join links on one = reach.class join classes c on c.class = other where reach.least < c.least),
 components as (select class, min(least) as component_id from reach group by class)
select doc_id, n as n_shingles, component_id, doc_id = component_id as kept from keyed join components using (class)""",
    "op12_search": rf"""with docs as (
  select row_number() over () as r, doc_id, {_TERMS} as terms from documents),
 sizes as (select r, doc_id, len(terms) as n from docs),
 whole as (select count(*) filter (n > 0) as big_n, sum(n)::bigint as big_l from sizes),
 posts as (select r, term, count(*) as tf from (select r, unnest(terms) as term from docs) group by r, term),
 items as (select row_number() over () as q, item_id, {_TERMS} as terms from benchmark),
 asked as (select q, term, count(*) as times from (select q, unnest(terms) as term from items) group by q, term),
 weights as (
  select term, floor(1000 * ln((2 * any_value(big_n) + 2)::double / (2 * count(*) + 1)))::bigint as w from posts, whole group by term),
 scores as (
  select q, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::bigint as score
  from asked join weights using (term) join posts using (term) join sizes using (r), whole group by q, r),
 ranked as (
  select item_id, (row_number() over (partition by q order by score desc, doc_id nulls last))::int as rank, doc_id, score
  from scores join items using (q) join sizes using (r) where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= {lexical.TOP}""",
    "op13_resample": rf"""with crc as (
  select list(c order by n) as entries from (
    select n, list_reduce(list_prepend(n, range(8)), lambda c, i: case c % 2 when 1 then xor(3988292384::bigint, c // 2) else c // 2 end) as c from range(256) t(n))),
 rows as (
  select row_number() over () as r, true as source, doc_id, {_FEATURES} as words from documents
  union all select -row_number() over (), false, null, {_FEATURES} from benchmark),
 placed as (select r, source, unnest(words) as word, generate_subscripts(words, 1) as k from rows),
 uses as (
  select r, source, word as feature from placed
  union all select * from (select r, source, word || ' ' || lead(word) over (partition by r order by k) as feature from placed) where feature is not null),
 hashed as (
  select feature, xor(4294967295::bigint, list_reduce(
      list_prepend(4294967295::bigint, list_transform(range(1, strlen(feature) + 1), lambda i: ('0x' || substr(hex(feature), 2 * i - 1, 2))::bigint)),
      lambda c, b: xor(c // 256, entries[xor(c & 255, b) + 1]))) % {resample.BUCKETS} as bucket
  from (select distinct feature from uses), crc),
 counts as (
  select bucket, count(*) filter (source) as s, count(*) filter (not source) as t from uses join hashed using (feature) group by bucket),
 gains as (
  select bucket, floor(1000 * ln(((t + 1) * (sum(s) over () + {resample.BUCKETS}))::double / ((s + 1) * (sum(t) over () + {resample.BUCKETS}))::double))::bigint as gain from counts),
 sums as (
  select r, count(*) as n, sum(gain) as gain from uses join hashed using (feature) join gains using (bucket) where source group by r),
 weighted as (
  select r, doc_id, len(words) as n_words, coalesce(n, 0)::bigint as n_features, coalesce(floor(gain::double / n), 0)::bigint as weight,
    ('0x' || substr(sha256('{resample.SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h
  from rows left join sums using (r) where source),
 scored as (
  select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score from weighted),
 ranked as (
  select r, row_number() over (order by score desc, doc_id nulls last) as rank, count(*) over () as fit from scored where n_words >= {resample.WORDS})
select doc_id, n_features, weight, score, case when rank <= {resample.PERCENT} * fit // 100 then rank end as rank from scored left join ranked using (r)""",
}

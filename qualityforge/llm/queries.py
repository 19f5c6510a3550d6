"""The registered queries of this subpackage, their production parameters and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualityforge.llm import crf_quality, exact_dedup, fuzzy_lines, kn_language, merkle, mixing, packing, prefix_join, repeats, simple8b, toxicity, url_rules, whitening

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


CORPUS_MIX = mixing.Mix(
    levels=("domain", "lang", "source"),
    weights={
        "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
        "lang": {"en": 6, "de": 2, "fr": 2, "es": 1},
        "source": {"src0": 3, "src5": 2, "src10": 2},
    },
    epochs=3,
)


def domain_of(source: str = "source"):
    """Sources come numbered; five neighbours form a domain. Without a number: domain 0."""
    number = F.nullif(F.regexp_extract(F.col(source), "([0-9]{1,9})$", 1), F.lit("")).cast("int")
    return F.concat(F.lit("d"), F.floor(F.coalesce(number, F.lit(0)) / 5).cast("string"))


def _case(level: str) -> str:
    cases = "".join(f" WHEN '{n}' THEN {w}" for n, w in CORPUS_MIX.weights[level].items())
    return f"CASE {level}{cases} ELSE 1 END"


def _mix_sql() -> str:
    """Tree budgets and a plain running sum per leaf."""
    sql = [
        """WITH sizes AS (
      SELECT doc_id, 'd' || (coalesce(try_cast(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') AS INT), 0) // 5) AS domain,
        coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents)"""
    ]
    above = None
    for depth, level in enumerate(CORPUS_MIX.levels):
        parents = list(CORPUS_MIX.levels[:depth])
        keys = ", ".join([*parents, level])
        part = f"PARTITION BY {', '.join(parents)}" if parents else ""
        total = f"JOIN {above} USING ({', '.join(parents)})" if parents else f"CROSS JOIN (SELECT sum(n_tokens) * {CORPUS_MIX.parts} // {CORPUS_MIX.of} AS total FROM sizes)"
        need = f"{part} ORDER BY cap::DOUBLE / w, {level}"
        sql.append(f"""a{depth} AS (SELECT {keys}, (sum(n_tokens) * {CORPUS_MIX.epochs})::HUGEINT AS cap, ({_case(level)})::HUGEINT AS w FROM sizes GROUP BY {keys}),
    b{depth} AS (SELECT *, least(total, sum(cap) OVER ({part}))::HUGEINT AS t FROM a{depth} {total}),
    c{depth} AS (SELECT *, cap * sum(w) OVER ({need} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        <= (t - coalesce(sum(cap) OVER ({need} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS f0 FROM b{depth}),
    d{depth} AS (SELECT *, bool_and(f0) OVER ({need} ROWS UNBOUNDED PRECEDING) AS f FROM c{depth}),
    e{depth} AS (SELECT *, t - coalesce(sum(cap) FILTER (f) OVER ({part}), 0) AS l, sum(w) FILTER (NOT f) OVER ({part}) AS ws FROM d{depth}),
    f{depth} AS (SELECT *, CASE WHEN f THEN cap ELSE (l * w)::HUGEINT // ws::HUGEINT END AS fl FROM e{depth}),
    g{depth} AS (SELECT *, t - sum(fl) OVER ({part}) AS u, row_number() OVER ({part} ORDER BY f,
        CASE WHEN NOT f THEN l * w - fl * ws END DESC NULLS LAST, {level}) AS r FROM f{depth}),
    s{depth} AS (SELECT {keys}, (fl + CASE WHEN r <= u THEN 1 ELSE 0 END)::BIGINT AS total FROM g{depth})""")
        above = f"s{depth}"
    sql.append("""h AS (SELECT sizes.*, total AS budget, sum(n_tokens) OVER (PARTITION BY domain, lang, source)::BIGINT AS tokens
      FROM sizes JOIN s2 USING (domain, lang, source)),
    i AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS full_epochs, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM h),
    j AS (SELECT *, (sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('""" + str(CORPUS_MIX.seed) + """:' || full_epochs || ':' || doc_id), doc_id
      ROWS UNBOUNDED PRECEDING) - n_tokens)::BIGINT AS before FROM i),
    k AS (SELECT *, greatest(0, least(n_tokens, rest - before)) AS last_tokens FROM j)
    SELECT doc_id, domain, lang, source, n_tokens, budget, full_epochs, last_tokens, full_epochs * n_tokens + last_tokens AS used_tokens FROM k""")
    return ",\n    ".join(sql[:-1]) + ",\n    " + sql[-1]


def corpus_sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", domain_of().alias("domain"), "lang", "source", mixing.count_words().alias("n_tokens"))


@query("op2_mix_sources", _mix_sql())
def mix_sources(spark: SparkSession, base: str) -> DataFrame:
    return mixing.mix_sources(corpus_sizes(table(spark, base, "documents")), CORPUS_MIX)


@query(
    "op9_exact_dedup",
    """WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
      doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n""",
)
def exact_dedup_query(spark: SparkSession, base: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, base, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def fold(key: str, parts: int):
    """Remainder of the CRC-32 of the key as text; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts


@query("op5_language_id")
def language_id(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    part = fold("doc_id", 5)
    model = kn_language.train(docs, "doc_id", "text", "lang", learn=part > 1, calibrate=part == 1)
    return kn_language.predict(docs, model).select("doc_id", (part == 0).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


@query("op6_quality_rules")
def quality_rules(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    return crf_quality.judge(docs, crf_quality.train(docs, table(spark, base, "labels")))


@query("op8_toxicity")
def toxicity_query(spark: SparkSession, base: str) -> DataFrame:
    docs, part = table(spark, base, "documents"), fold("doc_id", 3)
    model = toxicity.train(docs, table(spark, base, "labels").filter(part != 1))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (part == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def tokenizer_path(spark: SparkSession) -> str:
    """Place of the tokenizer's file on every worker: the session's setting, else the installed one."""
    import public_tokenizers

    return spark.conf.get("qualityforge.tokenizer", public_tokenizers.path("word_bpe_49k.json"))


@query("op7_token_ids")
def token_ids(spark: SparkSession, base: str) -> DataFrame:
    return simple8b.token_table(table(spark, base, "documents"), tokenizer_path(spark), end_id=2)


# Fixed rules: host, path, verdict.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


@query("op4_url_filter")
def url_filter(spark: SparkSession, base: str) -> DataFrame:
    """Pages are labelled by the row of ``labels`` that carries their id: low quality or toxic means block."""
    labels = table(spark, base, "labels")
    flags = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"))
    return url_rules.judge_urls(table(spark, base, "pages"), URL_RULES, flags)


def packable(docs: DataFrame) -> DataFrame:
    """Sizes in words; documents equal but for ASCII case are one cluster."""
    return docs.select("doc_id", "source", F.md5(F.encode(exact_dedup.normalised(), "UTF-8")).alias("cluster"), mixing.count_words().alias("n_tokens"))


@query("op10_best_fit_packing")
def best_fit_packing(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack_documents(packable(table(spark, base, "documents")))


@query("op3_prefix_join")
def prefix_join_query(spark: SparkSession, base: str) -> DataFrame:
    return prefix_join.jaccard_components(table(spark, base, "documents"))


@query("op1_fuzzy_lines")
def fuzzy_lines_query(spark: SparkSession, base: str) -> DataFrame:
    return fuzzy_lines.line_verdicts(table(spark, base, "documents"))


@query("op11_repeated_passages")
def repeated_passages(spark: SparkSession, base: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, base, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, base: str) -> DataFrame:
    return whitening.whiten(table(spark, base, "embeddings"))


def _merkle_sql(deep: int = 16) -> str:
    """Levels one by one; ``deep`` levels hold 3 ** deep rows of a source, and as many sources."""
    crc = """xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda a, z: xor(a >> 1, 3988292384::UBIGINT * (a & 1)))), 4294967295::UBIGINT)"""
    field = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
    row = "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
    sql = [
        f"""WITH leaves AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS g, {row.format(text="text")} AS leaf,
      CASE WHEN {crc} % 2 = 0 THEN {row.format(text="replace(text, chr(10), '')")} ELSE {row.format(text="text")} END AS claimed FROM documents)""",
        """a0 AS MATERIALIZED (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS p, leaf AS h, doc_id, claimed FROM leaves)""",
        "w0 AS MATERIALIZED (SELECT doc_id, g, p, h AS leaf, claimed AS node, '' AS proof FROM a0)",
    ]
    for side, keep in (("a", "doc_id, leaf"), ("b", "doc_id, leaf, g0, subroot")):
        if side == "b":
            sql.append(f"tops AS MATERIALIZED (SELECT g, h FROM a{deep})")
            sql.append("b0 AS MATERIALIZED (SELECT '' AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS p, h, g AS g0 FROM tops)")
            sql.append(f"v0 AS MATERIALIZED (SELECT w.doc_id, w.leaf, w.g AS g0, b0.h AS subroot, b0.g, b0.p, w.node, w.proof FROM w{deep} w JOIN b0 ON b0.g0 = w.g)")
        walk = "w" if side == "a" else "v"
        for i in range(deep):
            sql.append(f"""{side}{i + 1} AS MATERIALIZED (SELECT g, CASE WHEN n > 1 THEN p // 3 ELSE p END AS p, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE min(h) END AS h
        FROM (SELECT g, p, h, count(*) OVER (PARTITION BY g) AS n FROM {side}{i}) GROUP BY g, CASE WHEN n > 1 THEN p // 3 ELSE p END, n)""")
            sql.append(f"""{side}s{i} AS MATERIALIZED (SELECT x.g, x.p, count(*) OVER (PARTITION BY x.g) AS n,
        coalesce(l2.h, '') || coalesce(l1.h, '') AS l, coalesce(r1.h, '') || coalesce(r2.h, '') AS r FROM {side}{i} x
        LEFT JOIN {side}{i} l1 ON l1.g = x.g AND l1.p = x.p - 1 AND x.p % 3 >= 1 LEFT JOIN {side}{i} l2 ON l2.g = x.g AND l2.p = x.p - 2 AND x.p % 3 = 2
        LEFT JOIN {side}{i} r1 ON r1.g = x.g AND r1.p = x.p + 1 AND x.p % 3 <= 1 LEFT JOIN {side}{i} r2 ON r2.g = x.g AND r2.p = x.p + 2 AND x.p % 3 = 0)""")
            sql.append(f"""{walk}{i + 1} AS MATERIALIZED (SELECT {keep}, d.g, CASE WHEN n > 1 THEN d.p // 3 ELSE d.p END AS p,
        CASE WHEN n > 1 THEN sha256(l || node || r) ELSE node END AS node, CASE WHEN n > 1 THEN proof || l || r ELSE proof END AS proof
        FROM {walk}{i} d JOIN {side}s{i} s ON s.g = d.g AND s.p = d.p)""")
    return ",\n    ".join(sql) + f"""
    SELECT doc_id, leaf, subroot, b{deep}.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = b{deep}.h AS verified FROM v{deep} v JOIN b{deep} ON b{deep}.g = v.g"""


@query("op13_merkle_manifest", _merkle_sql())
def merkle_manifest(spark: SparkSession, base: str) -> DataFrame:
    """Rows whose id has an even CRC-32 are proven with the newlines of their text deleted."""
    docs = table(spark, base, "documents")
    rest = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    bare = F.replace("text", F.lit("\n"), F.lit(""))
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    leaf = merkle.leaf_of(*rest, F.col("text"))
    return merkle.manifest(docs, "doc_id", "source", leaf, F.when(tampered, merkle.leaf_of(*rest, bare)).otherwise(leaf))

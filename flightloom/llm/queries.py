"""The registered queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, decontamination, lexical_search, line_dedup, merkle, ngram_join, packing, pii, substring_dedup, toxicity, url_filter, vector_dedup
from .url_filter import Rule

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SEQUENCE_TOKENS = 1024

# The rules of the URL query.
URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, public_tokenizers.PATTERN, SEQUENCE_TOKENS)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.round_trip(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest = F.sha2(pii.joined("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *[count(kind) for kind in pii.KINDS], digest, pii.joined("spans").alias("spans"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held_out = (toxicity.fold(F.col("doc_id")) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted", "n_tokens", "best", "units")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return deduped.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", digest)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    changed = F.when(tampered, merkle.leaf_of(changes={"text": merkle.lower_ascii}))
    found = merkle.manifest(table(spark, sf_dir, "documents"), changed)
    folded = found.withColumn("folded_root", merkle.fold(F.col("checked"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontamination.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return marked.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names.cast("binary"), 256).alias("items_sha256"),
                         (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_vector_dedup": op2_vector_dedup,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_ann": op5_ann,
    "op6_line_dedup": op6_line_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_bpe": op8_bpe,
    "op9_ngram_join": op9_ngram_join,
    "op10_url_filter": op10_url_filter,
    "op11_merkle": op11_merkle,
    "op12_lexical_search": op12_lexical_search,
    "op13_decontamination": op13_decontamination,
}




# DuckDB has no crc32: eight steps a byte over the ids' digits.
_CRC32 = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase


def _merkle_sql(levels: int = 6, group_levels: int = 4) -> str:
    """Levels written out one by one: up to 16 ** ``levels`` rows a source and 16 ** ``group_levels`` sources."""

    def framed(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(framed(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    def tree(name: str, depth: int) -> list[str]:
        """Levels ``name``0 (tree, n, i, h) upwards, the tops and each node's siblings before and after it."""
        parts = [f"{name}{d + 1} AS (SELECT tree, n, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}{d} WHERE n > {16 ** d} GROUP BY tree, n, i // 16)"
                 for d in range(depth)]
        tops = " UNION ALL ".join(f"SELECT tree, h FROM {name}{d} WHERE n <= {16 ** d}" + (f" AND n > {16 ** (d - 1)}" if d else "") for d in range(depth + 1))
        parts.append(f"{name}_top AS ({tops})")
        parts += [f"""{name}_step{d} AS (
            SELECT a.tree, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS before,
                   coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS after
            FROM {name}{d} a JOIN {name}{d} b ON a.tree = b.tree AND a.i // 16 = b.i // 16 WHERE a.n > {16 ** d} GROUP BY a.tree, a.i)""" for d in range(depth)]
        return parts

    steps, proof, joins = [], [], []
    for name, depth, owner, rank in (("node", levels, "d.tree", "d.i"), ("src", group_levels, "''", "s.i")):
        if name == "src":
            joins.append("JOIN src_leaf s ON s.owner = d.tree")
        for d in range(depth):
            at = f"{name}_at{d}"
            steps.append(at)
            joins.append(f"LEFT JOIN {name}_step{d} {at} ON {at}.tree = {owner} AND {at}.i = {rank} // {16 ** d}")
            proof.append(f"coalesce({at}.before || {at}.after, '')")
    folds, source = [], "path"
    for n, at in enumerate(steps):
        folds.append(f"fold{n} AS (SELECT * EXCLUDE (checked), CASE WHEN {at}_b IS NULL THEN checked ELSE sha256({at}_b || checked || {at}_a) END AS checked FROM {source})")
        source = f"fold{n}"
    columns = ", ".join(f"{at}.before AS {at}_b, {at}.after AS {at}_a" for at in steps)
    return f"""
        WITH hashed AS (
            SELECT doc_id, coalesce('1' || source, '0') AS tree, {leaf('text')} AS h,
                   CASE WHEN {_CRC32} % 5 = 0 THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS changed
            FROM documents
        ),
        leaf AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
        node0 AS (SELECT tree, n, i, h FROM leaf),
        {', '.join(tree('node', levels))},
        src_leaf AS (SELECT '' AS tree, tree AS owner, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM node_top),
        src0 AS (SELECT tree, n, i, h FROM src_leaf),
        {', '.join(tree('src', group_levels))},
        path AS (
            SELECT d.doc_id, d.h AS leaf, s.h AS subroot, r.h AS root, coalesce(d.changed, d.h) AS checked, sha256({' || '.join(proof)}) AS proof_sha256, {columns}
            FROM leaf d {' '.join(joins)} CROSS JOIN src_top r
        ),
        {', '.join(folds)}
        SELECT doc_id, leaf, subroot, root, proof_sha256, checked AS folded_root, checked = root AS verified FROM {source}
    """


#: Terms of a lower-cased text, as a list.
_TERMS = f"""list_filter(string_split(regexp_replace(translate(text, '{_UPPER}', '{_LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), lambda t: t <> '')"""

ORACLE: dict[str, str] = {
    "op11_merkle": _merkle_sql(),
    "op12_lexical_search": f"""
        WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
        filled AS (SELECT rid, doc_id, terms, len(terms)::BIGINT AS n FROM doc WHERE len(terms) > 0),
        total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM filled),
        occurrence AS (SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT rid, doc_id, n, unnest(terms) AS term FROM filled) GROUP BY ALL),
        holding AS (SELECT term, count(*)::BIGINT AS df FROM occurrence GROUP BY term),
        item AS (SELECT row_number() OVER () AS item_at, item_id, {_TERMS} AS terms FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
        asked AS (SELECT item_at, item_id, term, count(*)::BIGINT AS often FROM (SELECT item_at, item_id, unnest(terms) AS term FROM item) GROUP BY ALL),
        weighed AS (
            SELECT a.item_at, a.item_id, a.term, a.often * floor(1000 * ln((2 * t.docs + 2) / (2 * h.df + 1)::DOUBLE))::BIGINT AS w
            FROM asked a JOIN holding h USING (term) CROSS JOIN total t
        ),
        scored AS (
            SELECT w.item_at, w.item_id, o.rid, o.doc_id,
                   sum(w.w * ((1000000000 * o.tf) // (1000 * o.tf + 12 * (75 + (25 * o.n * t.docs) // t.words))))::BIGINT AS score
            FROM weighed w JOIN occurrence o USING (term) CROSS JOIN total t GROUP BY ALL
        ),
        placed AS (SELECT *, row_number() OVER (PARTITION BY item_at ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0)
        SELECT item_id, place::INTEGER AS rank, doc_id, score FROM placed WHERE place <= 20
    """,
    "op13_decontamination": f"""
        WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_TERMS}, []) AS words FROM documents),
        item AS (SELECT item_id, {_TERMS} AS words FROM benchmark WHERE text IS NOT NULL),
        wanted AS (
            SELECT DISTINCT item_id, least(len(words), 10) AS width, list_slice(words, i, i + 9) AS w
            FROM item, LATERAL (SELECT unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i) WHERE len(words) > 0
        ),
        widths AS (SELECT DISTINCT width FROM wanted),
        held AS (
            SELECT d.rid, p.i, s.width, list_slice(d.words, p.i, p.i + s.width - 1) AS w
            FROM doc d CROSS JOIN widths s, LATERAL (SELECT unnest(range(1, len(d.words) - s.width + 2)) AS i) p
        ),
        occurring AS (SELECT h.rid, h.i, h.width, t.item_id FROM held h JOIN wanted t ON h.w = t.w),
        hit AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT rid, i, width FROM occurring) o, LATERAL (SELECT unnest(range(o.i, o.i + o.width)) AS j) GROUP BY rid),
        named AS (SELECT rid, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
                  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS name FROM occurring WHERE item_id IS NOT NULL) GROUP BY rid)
        SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(n.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
        FROM doc d LEFT JOIN hit h USING (rid) LEFT JOIN named n USING (rid)
    """,
    "op6_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, i - 1 AS i, line[i] AS line
            FROM (SELECT doc_id, string_split(text, chr(10)) AS line FROM documents WHERE text IS NOT NULL),
                 LATERAL (SELECT unnest(range(1, len(line) + 1)) AS i)
        ),
        solid AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS j, line
            FROM lines WHERE regexp_matches(line, '[^ \t\r\x0b\x0c]')
        ),
        windows AS (
            SELECT a.doc_id, a.j, a.i AS first_line, c.i AS last_line, a.line AS x, b.line AS y, c.line AS z
            FROM solid a JOIN solid b ON b.doc_id = a.doc_id AND b.j = a.j + 1 JOIN solid c ON c.doc_id = a.doc_id AND c.j = a.j + 2
        ),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, j) AS place FROM windows),
        later AS (SELECT * FROM ranked WHERE place > 1),
        marked AS (
            SELECT *, CASE WHEN j <= lag(j) OVER (PARTITION BY doc_id ORDER BY j) + 3 THEN 0 ELSE 1 END AS fresh FROM later
        ),
        numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY j) AS run FROM marked),
        runs AS (SELECT doc_id, run, min(first_line) AS first_line, max(last_line) AS last_line FROM numbered GROUP BY ALL),
        gone AS (SELECT DISTINCT l.doc_id, l.i FROM lines l JOIN runs r ON l.doc_id = r.doc_id AND l.i BETWEEN r.first_line AND r.last_line),
        kept AS (
            SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
                   coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS kept
            FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id
        )
        SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
               sha256(coalesce(k.kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
    """,
}

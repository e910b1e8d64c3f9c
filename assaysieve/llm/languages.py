"""Language identification by fusing evidence.

The text gives likelihoods of character n-grams; the declared markup language and the suffix of the address are further observations with learned
error rates; the host and its domain give a prior that is shrunk towards the level above the fewer rows they have. All site and error
tables come from grouped aggregation.
"""

import html
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from assaysieve.llm import sites
from assaysieve.llm.text import per_text, pieces
from assaysieve.session import checkpointable, scratch_path

SAMPLE_ROWS = 4_000  # distinct labelled texts per language that the n-gram model is fitted on: all, or about so many dealt by hash
POOLED = 0.03  # share of the n-grams of all languages in each one's: what no language has seen favours none, however few texts one has
BUCKETS = 1 << 16  # hashed n-grams of the model
TEMPER = 4.0  # n-grams overlap and depend on each other: so many count as one
HOST_ROWS, DOMAIN_ROWS = 5.0, 20.0  # rows that the domain weighs against a host, and all rows against a domain
SLICE = 128  # languages whose n-grams are copied to the executors at once: 32 MB
ERROR_ROWS = 20.0  # rows that the prior of an observation's error table weighs
DECLARED_RIGHT = 0.9

_TAG_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.I)
_SILENT = re.compile(r"<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*>|<[^>]*\Z", re.I | re.S)
SEEN = "declared string, words bigint, scores array<double>"


@cache
def _letters() -> np.ndarray:
    """Which of the first 65,536 code points are letters; the ones beyond count as letters."""
    return np.array([chr(c).isalpha() for c in range(1 << 16)])


def visible(markup: str) -> str:
    return html.unescape(_SILENT.sub(" ", markup))


def buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every letter of the texts the bucket of the three characters around it, the number of its text, and words per text.

    Texts are taken in lower case; everything but letters is one kind of gap.
    """
    lower = [(t or "").lower() for t in texts]
    points = np.frombuffer((" " + " ".join(lower) + "  ").encode("utf-32-le", "replace"), np.uint32)
    letter = np.ones(points.size, bool)
    low = points < (1 << 16)
    letter[low] = _letters()[points[low]]
    points = np.where(letter, points, 0).astype(np.uint64)
    ends = np.cumsum([len(t) + 1 for t in lower])  # where the gap after each text stands
    at = np.flatnonzero(letter)
    mixed = (points[at - 1] * np.uint64(0x9E3779B97F4A7C15) + points[at]) * np.uint64(0xC2B2AE3D27D4EB4F) + points[at + 1]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    of = np.searchsorted(ends, at, "right")
    begins = at[~letter[at - 1]]
    words = np.bincount(np.searchsorted(ends, begins, "right"), minlength=len(texts))
    return (mixed >> np.uint64(48)).astype(np.int64), of, words


def _count(batches):
    """Bucket counts per language, summed within each batch."""
    for batch in batches:
        frame = batch.to_pandas()
        for lang, own in frame.groupby("_lang"):
            counts = sum(np.bincount(buckets(piece.to_pylist())[0], minlength=BUCKETS) for piece in pieces(pa.array(own["_text"], pa.string())))
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(used), "bucket": used, "n": counts[used]},
                                             schema=pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())]))


def _packed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    counts = np.zeros(BUCKETS, np.int64)
    counts[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return pa.table({"lang": pa.array([key[0].as_py()], pa.string()), "counts": pa.array([counts.tobytes()], pa.binary())})


def fit(documents: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """All languages of the labelled rows, and log-probabilities of n-gram buckets per language.

    N-grams are counted over distinct texts, so copies weigh nothing: all texts of a language that has at most `sample_rows`, else about as many,
    dealt by hash. Rows with a null text or language are left out. Without any, there are no languages and every result is null.
    """
    labelled = documents.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    hashed = labelled.withColumn("_h", F.xxhash64("_text"))
    sizes = hashed.select("_lang", "_h").distinct().groupBy("_lang").agg(F.count("*").alias("_n")).orderBy("_lang").collect()
    langs = sorted(r["_lang"] for r in sizes)
    shares = documents.sparkSession.createDataFrame([(r["_lang"], sample_rows / r["_n"]) for r in sizes], "_lang string, _share double")
    inside = F.shiftrightunsigned("_h", 11) < F.col("_share") * float(1 << 53)
    sample = hashed.join(F.broadcast(shares), "_lang").where(inside).select("_lang", "_text").distinct()
    summed = sample.mapInArrow(_count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((BUCKETS, len(langs)))
    for row in summed.groupBy("lang").applyInArrow(_packed, "lang string, counts binary").toLocalIterator():  # one row of BUCKETS numbers per language
        counts[:, langs.index(row["lang"])] = np.frombuffer(row["counts"], np.int64)
    pooled = (counts.sum(1, keepdims=True) + 0.5) / (counts.sum() + 0.5 * BUCKETS)
    own = np.where(counts.sum(0) > 0, counts / np.maximum(counts.sum(0), 1), pooled)
    return langs, np.log((1 - POOLED) * own + POOLED * pooled)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def domain_of(host: Column) -> Column:
    """The last two labels of a host: what its subdomains share."""
    return F.regexp_extract(host, r"([^.]+\.[^.]+)\.?$", 1)


def suffix_of(url: Column, langs: list[str]) -> Column:
    """The language that the address names: by its first path segment, else by the last label of its host; null if none."""
    segment = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([A-Za-z]{2,3})(?:[-_][A-Za-z]+)?(?:[/?#]|$)", 1))
    label = F.regexp_extract(host_of(url), r"\.([a-z]{2,3})\.?$", 1)
    known = [F.when(c.isin(langs), c) for c in (segment, label)] if langs else [F.lit(None).cast("string")]
    return F.coalesce(*known)


def _seen(content: Column, markup: bool, model: tuple, spark) -> Column:
    """What a text says: its declared language, its words, and a score per language. The model is copied to the executors in slices of languages."""
    slices = []
    for begin in range(0, len(model[0]), SLICE):
        shared = spark.sparkContext.broadcast(np.ascontiguousarray((model[1][:, begin:begin + SLICE] / TEMPER).astype(np.float32)))

        def make(shared=shared):
            table = shared.value

            def rows(texts: list[str | None]) -> list[tuple]:
                shown = [visible(t) if markup and t else t for t in texts]
                tags = [_TAG_LANG.search(t) if markup and t else None for t in texts]
                bucket, of, words = buckets(shown)
                scores = np.stack([np.bincount(of, table[bucket, i], minlength=len(texts)) for i in range(table.shape[1])], 1)
                return [(tag[1].lower() if tag else None, int(n), own) for tag, n, own in zip(tags, words, scores.tolist(), strict=True)]

            return rows

        slices.append(per_text(make, SEEN)(content))
    return slices[0] if len(slices) == 1 else F.struct(slices[0]["declared"].alias("declared"), slices[0]["words"].alias("words"),
                                                      F.concat(*[s["scores"] for s in slices]).alias("scores"))


def _lists(column: pa.Array, width: int) -> np.ndarray:
    """Lists of `width` numbers as rows; zeros for null."""
    out = np.zeros((len(column), width))
    whole = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    if whole.size:
        out[whole] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(whole.size, width)
    return out


def _softmax(weights: np.ndarray) -> np.ndarray:
    raised = np.exp(weights - weights.max(1, keepdims=True))
    return raised / raised.sum(1, keepdims=True)


def _text_shares(languages: int):
    """Probabilities from the text alone; zeros without a word."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for scores, words in batches:
            shares = _softmax(_lists(scores, languages)) * (words.fill_null(0).to_numpy(zero_copy_only=False) > 0)[:, None]
            yield _as_lists(shares)

    return arrow_udf(run, returnType="array<double>")


def _as_lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.ravel())


def _fused(langs: list[str], tables: dict[str, dict[str, list[float]]], overall: np.ndarray):
    """All evidence of a row: its text, both observations, and the prior of its host and domain without the row itself."""
    k, names = len(langs), np.array(langs, object)
    silent = [0.0] * k

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for scores, words, shares, declared, suffix, host, host_rows, domain, domain_rows in batches:
            spoken = words.fill_null(0).to_numpy(zero_copy_only=False) > 0
            own, self_ = _lists(shares, k), spoken.astype(float)[:, None]
            rows = lambda c: c.fill_null(0.0).to_numpy(zero_copy_only=False)[:, None]
            above = np.maximum(_lists(domain, k) - own, 0) + DOMAIN_ROWS * overall
            above /= np.maximum(rows(domain_rows) - self_, 0) + DOMAIN_ROWS
            prior = np.maximum(_lists(host, k) - own, 0) + HOST_ROWS * above
            prior /= np.maximum(rows(host_rows) - self_, 0) + HOST_ROWS
            said = [np.array([tables[name].get(v, silent) for v in column.to_pylist()]) for name, column in (("declared", declared), ("suffix", suffix))]
            weights = _lists(scores, k) + said[0].reshape(-1, k) + said[1].reshape(-1, k) + np.log(prior)
            found = _softmax(weights)
            nothing = ~spoken & ~(declared.is_valid().to_numpy(zero_copy_only=False) | suffix.is_valid().to_numpy(zero_copy_only=False))
            detected = np.where(nothing, None, names[weights.argmax(1)])  # of equal languages the first by name
            yield pa.StructArray.from_arrays([pa.array(detected, pa.string()), pa.array(np.where(nothing, 0.0, found.max(1))), _as_lists(found)], ["detected", "confidence", "shares"])

    return arrow_udf(run, returnType="detected string, confidence double, shares array<double>")


def _errors(rows: list, langs: list[str]) -> dict[str, list[float]]:
    """log P(observed | language) per observed value, from summed text shares, smoothed towards a mostly right observation."""
    k = len(langs)
    sums = {r["seen"]: np.array(r["by"], float) for r in rows if r["seen"] in langs}
    totals = sum(sums.values(), np.zeros(k))
    out = {}
    for value in langs:
        prior = np.array([DECLARED_RIGHT if lang == value else (1 - DECLARED_RIGHT) / max(k - 1, 1) for lang in langs])
        out[value] = np.log((sums.get(value, np.zeros(k)) + ERROR_ROWS * prior) / (totals + ERROR_ROWS)).tolist()
    return out


EVIDENCE = "_language_evidence"  # the only column that the frame must not have


def identify(documents: DataFrame, model: tuple, content: str = "text", site: str | None = None, address: str | None = None, markup: bool = False,
             keep_content: bool = True) -> DataFrame:
    """The documents with `detected` (null without any evidence), `confidence`, `declared`, `suffix` and `shares` per language.

    `address` is a column of URLs; `site` one of plain site names where there are no URLs. Evidence that is missing (null or empty text, no
    declared language, unknown values, no address) says nothing. A row's own text does not count in the prior of its host. Columns called like the new ones are
    replaced, all others stay; without `keep_content` the texts are left behind, and what they say is written down once instead of being worked out in both passes.
    """
    langs, spark = model[0], documents.sparkSession
    checkpointable(spark)
    k = len(langs)
    carried = documents if keep_content else documents.drop(content)
    if not langs:
        none = F.lit(None).cast("string")
        return carried.withColumns({"detected": none, "confidence": F.lit(0.0), "declared": none, "suffix": none,
                                    "shares": F.array().cast("array<double>")})
    host = host_of(F.col(address)) if address else F.col(site).cast("string") if site else F.lit(None).cast("string")
    suffix = suffix_of(F.col(address), langs) if address else F.lit(None).cast("string")
    seen = documents.withColumn(EVIDENCE, _seen(F.col(content), markup, model, spark))
    e = F.col(EVIDENCE)
    seen = seen.withColumn(EVIDENCE, F.struct(
        F.when(e["declared"].isin(langs), e["declared"]).alias("declared"), e["words"].alias("words"), e["scores"].alias("scores"), suffix.alias("suffix"), host.alias("host"),
        domain_of(host).alias("domain"), _text_shares(k)(e["scores"], e["words"]).alias("own")))
    if keep_content:
        wanted = list(dict.fromkeys(c for c in (content, site, address) if c))
        summed = seen.select(*[F.col(c) for c in wanted], EVIDENCE).select(EVIDENCE)
    else:
        path = scratch_path(spark, "language-evidence")
        seen.drop(content).write.parquet(path)
        seen = spark.read.parquet(path)
        summed = seen.select(EVIDENCE)

    def up(frame: DataFrame, by: Column, rows: Column, *keys) -> DataFrame:
        return frame.groupBy(*keys).agg(F.array(*[F.sum(F.get(by, F.lit(i))) for i in range(k)]).alias("by"), F.sum(rows).alias("n"))

    spoken = summed.where(e["words"] > 0)
    groups = up(spoken, e["own"], F.lit(1.0), *[e[c].alias(c) for c in ("host", "domain", "declared", "suffix")]).checkpoint()
    by, n = F.col("by"), F.col("n")
    total = up(groups, by, n).first()
    overall = (np.array(total["by"] if total["n"] else [0.0] * k) + 1) / ((total["n"] or 0) + k)
    tables = {}
    for name in ("declared", "suffix"):
        rows = up(groups.where(F.col(name).isNotNull()), by, n, F.col(name).alias("seen")).orderBy("seen").collect()  # a row per language
        tables[name] = _errors(rows, langs)
    hosts, domains = up(groups, by, n, "host", "domain"), up(groups, by, n, "domain")
    above = domains.select(F.col("domain").alias("_d"), F.col("by").alias("_domain_by"), F.col("n").alias("_domain_n"))
    priors = hosts.join(above, F.col("domain").eqNullSafe(F.col("_d")), "left").select(
        F.col("host").alias("_language_host"), F.struct(by.alias("by"), n.alias("n"), F.col("_domain_by").alias("domain_by"), F.col("_domain_n").alias("domain_n")).alias("_language_prior")).checkpoint()
    out = sites.with_groups(seen.withColumn("_language_host", e["host"]), priors, ["_language_host"], priors.count())
    prior = F.col("_language_prior")
    fused = _fused(langs, tables, overall)(e["scores"], e["words"], e["own"], e["declared"], e["suffix"], prior["by"], prior["n"], prior["domain_by"], prior["domain_n"])
    found = out.withColumn("_language_prior", fused)
    new = {**{c: prior[c] for c in ("detected", "confidence")}, "declared": e["declared"], "suffix": e["suffix"], "shares": prior["shares"]}
    kept = [F.col(c) for c in carried.columns if c not in new]
    return found.select(*kept, *[v.alias(c) for c, v in new.items()])


def digest(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """All documents and all pages with their language: documents by text and source, pages by all four kinds of evidence."""
    model = fit(documents)
    texts = identify(documents.select("doc_id", "text", "source"), model, "text", site="source", keep_content=False)
    marked = identify(pages.select("page_id", "url", "html"), model, "html", address="url", markup=True, keep_content=False)
    columns = ["detected", "confidence", "declared", "suffix"]
    none = F.lit(None).cast("bigint")
    return texts.select("doc_id", none.alias("page_id"), *columns).unionByName(
        marked.select(none.alias("doc_id"), F.col("page_id").cast("bigint").alias("page_id"), *columns))

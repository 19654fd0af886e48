"""Language identification by Bayesian evidence fusion.

Evidence on a text: its likelihood under per-language letter-trigram models, the language its markup declares, and where
it was found. The last is a hierarchy of priors by grouped aggregation: all rows, the address suffix, the host, each
smoothed towards the one above with STRENGTH pseudo rows. The declaration counts through a confusion table of declared
against likeliest language, so a declaration that is often wrong weighs little.

The trigram models are fitted on about SAMPLE declared rows of each language, chosen by a hash of the id (a documented
bound); everything else covers all rows. Every declared language with a trigram in its rows has a model, however few they
are: models are smoothed towards a background, the mean of all languages' distributions and an even one. A text that no
model explains better than the background is in none of the languages. Texts are scored whole. Models are a table of BUCKETS hashed trigrams per language
and the confusion table has a row per language, so both are bounded whatever the corpus; priors by host grow and are joined,
a broadcast only where Spark finds the stored table under its threshold, and a hot host's rows are reduced before any shuffle.

Defined cases: a text without letters, in none of the languages, or with a posterior under MIN_POSTERIOR, is rejected: `language` null, `accepted` false.
Unknown or null declarations, hosts and suffixes add no evidence. Ties go to the first language by name. Repeated rows are
judged each; an empty table gives no rows, and without any declared row all are rejected. Other columns pass untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changefold.llm.common import lean, stored, table

BUCKETS = 1 << 15
SAMPLE = 2000
#: A text weighs as much as this many trigrams at most: those of one text are not independent.
WEIGHT = 200
STRENGTH = 20.0
#: A model has the background at this weight, as texts hold words of other languages, and as much more as SMOOTH trigrams
#: are to its own.
BACKGROUND, SMOOTH = 0.5, 200.0
MIN_POSTERIOR = 0.5
#: Declared values that are languages: two or three letters, then perhaps a region.
_DECLARED = "^([a-z]{2,3})(?:[-_].*)?$"
#: Letters, small; every other ASCII byte becomes a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of a text that hold no run of two spaces."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS)
    b = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint32)
    grams = b[:-2] * np.uint32(66_049) + b[1:-1] * np.uint32(257) + b[2:]
    inside = (b[1:-1] != 32) | ((b[:-2] != 32) & (b[2:] != 32))
    return (grams[inside] * np.uint32(2_654_435_761)) >> np.uint32(17)


def document_evidence(docs: DataFrame) -> DataFrame:
    """Evidence of a documents table: `lang` is declared, `source` is the host, which has no suffix."""
    none = F.lit(None).cast("string")
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    return docs.select(rest.alias("rest"), "text", _declared(F.col("lang")), F.col("source").alias("host"), none.alias("suffix"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Evidence of a pages table: the html element's language, the address's host and its last label."""
    html, host = F.coalesce("html", F.lit("")), F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-z]+://([^/:?#]+)", 1))
    declared = _declared(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z_-]+)", 1))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), "<[^>]*>", " ")
    suffix = F.nullif(F.regexp_extract(host, r"\.([a-z]+)$", 1), F.lit(""))
    return pages.select(F.struct("page_id").alias("rest"), text.alias("text"), declared, F.nullif(host, F.lit("")).alias("host"), suffix.alias("suffix"))


def _declared(value: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(F.trim(value)), _DECLARED, 1), F.lit("")).alias("declared")


def fit_texts(evidence: DataFrame, id_hash: Column) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Log probabilities of trigram buckets by language, from about SAMPLE declared rows of each, and of the background."""
    declared = evidence.filter("declared is not null")
    counts = {r["declared"]: r["n"] for r in declared.groupBy("declared").agg(F.count("*").alias("n")).collect()}
    even = np.full(BUCKETS, 1 / BUCKETS)
    if not counts:
        return {}, np.log(even)
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, SAMPLE / n))))
    chosen = declared.filter(F.pmod(id_hash, F.lit(1 << 20)) < F.lit(1 << 20) * F.element_at(share, F.col("declared")))

    @lean
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                held[lang] += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
        cells = [(lang, np.flatnonzero(n)) for lang, n in held.items()]
        for lang, at in cells:
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(held[lang][at], pa.int64())],
                ["declared", "bucket", "n"],
            )

    summed = chosen.select("declared", "text").mapInArrow(count, "declared string, bucket int, n long")
    cells = summed.groupBy("declared", "bucket").agg(F.sum("n").alias("n"))
    rows = cells.groupBy("declared").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n")).collect()
    found = {}
    for r in sorted(rows, key=lambda r: r["declared"]):  # at most BUCKETS cells each
        found[r["declared"]] = n = np.zeros(BUCKETS)
        n[np.array(r["at"], np.int64)] = np.array(r["n"], np.float64)
    background = sum((n / n.sum() for n in found.values()), even) / (len(found) + 1)
    models = {}
    for lang, n in found.items():
        own = (n + SMOOTH * background) / (n.sum() + SMOOTH)
        models[lang] = np.log((1 - BACKGROUND) * own + BACKGROUND * background)
    return models, np.log(background)


def text_scores(evidence: DataFrame, models: dict[str, np.ndarray], background: np.ndarray, keep: list[str]) -> DataFrame:
    """The columns of `keep` with `n_grams`, `likelihood`, an array by language in the order of `models`, and `background`,
    the likelihood under that."""
    matrix = np.stack([*models.values(), background]).astype(np.float32)

    @lean
    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n, likelihood, none = [], [], []
            for text in batch.column(0):
                grams = trigrams(text.as_py())
                n.append(len(grams))
                mean = [float(m[grams].mean(dtype=np.float64)) if len(grams) else 0.0 for m in matrix]
                *each, other = (x * min(len(grams), WEIGHT) for x in mean)
                likelihood.append(each)
                none.append(other)
            scores = [pa.array(n, pa.int64()), pa.array(likelihood, pa.list_(pa.float64())), pa.array(none, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[first:], *scores], [*batch.schema.names[first:], "n_grams", "likelihood", "background"])

    held = evidence.select("text", *(c for c in keep if c != "text"))
    first = 0 if "text" in keep else 1
    schema = T.StructType([*held.schema[first:], *T.StructType.fromDDL("n_grams long, likelihood array<double>, background double")])
    return held.mapInArrow(score, schema)


def fuse(scored: DataFrame, languages: list[str], observed: DataFrame) -> DataFrame:
    """`scored` with `language`, `posterior`, `text_language` and `accepted`; counts come from `observed`, which has
    declared, host, suffix and `text_language` of all rows."""
    if not languages:
        null = F.lit(None).cast("string")
        return scored.withColumns({"language": null, "posterior": F.lit(0.0), "text_language": null, "accepted": F.lit(False)})
    seen = observed.filter("text_language is not null")
    pairs = {
        (r["declared"], r["text_language"]): r["n"]
        for r in seen.filter(F.col("declared").isin(languages)).groupBy("declared", "text_language").agg(F.count("*").alias("n")).collect()
    }
    totals = {lang: sum(pairs.get((d, lang), 0) for d in languages) for lang in languages}
    said = F.create_map(
        *(
            x
            for d in languages
            for x in (
                F.lit(d),
                F.array(*(F.lit(float(np.log((pairs.get((d, x), 0) + 1) / (totals[x] + len(languages))))) for x in languages)),
            )
        )
    )

    def tallies(*keys):
        each = [F.sum((F.col("text_language") == x).cast("double")).alias(f"n{i}") for i, x in enumerate(languages)]
        return seen.groupBy(*keys).agg(*each)

    def smoothed(counts, above):
        total = sum((F.col(f"n{i}") for i in range(len(languages))), F.lit(STRENGTH))
        return F.array(*((F.col(f"n{i}") + STRENGTH * above[i]) / total for i in range(len(languages))))

    top = tallies().first()
    world = [((top[i] or 0.0) + 1.0) / (sum(x or 0.0 for x in top) + len(languages)) for i in range(len(languages))]
    world = F.array(*map(F.lit, world))
    suffixes = tallies("suffix").filter("suffix is not null").select("suffix", smoothed(None, world).alias("suffix_prior"))
    suffixes = stored(suffixes, "suffix-priors")
    hosts = tallies("host", "suffix").filter("host is not null").join(suffixes, "suffix", "left")
    hosts = hosts.select("host", F.col("suffix").alias("of"), smoothed(None, F.coalesce("suffix_prior", world)).alias("host_prior"))
    hosts = stored(hosts, "host-priors")  # so that Spark knows its size when it plans the join
    joined = scored.join(hosts, (scored["host"] == hosts["host"]) & scored["suffix"].eqNullSafe(hosts["of"]), "left").drop(hosts["host"], "of")
    joined = joined.join(suffixes, "suffix", "left")
    prior = F.coalesce("host_prior", "suffix_prior", world)
    flat = F.array(*[F.lit(0.0)] * len(languages))
    word = F.coalesce(F.element_at(said, F.col("declared")), flat) if pairs else flat
    total = F.zip_with(F.zip_with("likelihood", word, lambda a, b: a + b), prior, lambda a, b: a + F.log(b))
    joined = joined.withColumn("total", total).withColumn("peak", F.array_max("total"))
    best = F.element_at(F.array(*map(F.lit, languages)), F.array_position("total", F.col("peak")).cast("int"))
    posterior = 1 / F.aggregate("total", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("peak")))
    accepted = explained() & (posterior >= MIN_POSTERIOR)
    return joined.withColumns(
        {"posterior": posterior, "accepted": accepted, "language": F.when(accepted, best), "text_language": likeliest(languages)}
    ).drop("total", "peak", "host_prior", "suffix_prior")


def explained() -> Column:
    """Whether some model explains a text better than the background."""
    return (F.col("n_grams") > 0) & (F.array_max("likelihood") > F.col("background"))


def likeliest(languages: list[str]) -> Column:
    if not languages:
        return F.lit(None).cast("string")
    names = F.array(*map(F.lit, languages))
    at = F.array_position("likelihood", F.array_max("likelihood")).cast("int")
    return F.when(explained(), F.element_at(names, at))


def identify(evidence: DataFrame, id_hash: Column) -> DataFrame:
    """One row per row of `evidence`, with its `key` and without its text."""
    models, background = fit_texts(evidence, id_hash)
    keep = ["key", "declared", "host", "suffix"]
    scored = stored(text_scores(evidence, models, background, keep), "language")
    observed = scored.withColumn("text_language", likeliest([*models]))
    return fuse(scored, [*models], observed)


def identify_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, declared, language, posterior, text_language, accepted, n_grams) of every document."""
    evidence = document_evidence(docs).withColumn("key", F.col("rest.doc_id"))
    found = identify(evidence, F.xxhash64("key"))
    return found.select(F.col("key").alias("doc_id"), "declared", "language", "posterior", "text_language", "accepted", "n_grams")


def identify_pages(pages: DataFrame) -> DataFrame:
    """The same of every page, with `page_id`."""
    evidence = page_evidence(pages).withColumn("key", F.col("rest.page_id"))
    found = identify(evidence, F.xxhash64("key"))
    return found.select(F.col("key").alias("page_id"), "declared", "language", "posterior", "text_language", "accepted", "n_grams")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is accepted, with their columns as they are. Texts are scored once to gather the
    counts and once more as they pass, so no text is shuffled or stored and ids need not be unique."""
    evidence = document_evidence(docs)
    models, background = fit_texts(evidence, F.xxhash64("rest.doc_id"))
    observed = stored(text_scores(evidence, models, background, ["declared", "host", "suffix"]), "language")
    observed = observed.withColumn("text_language", likeliest([*models]))
    passing = text_scores(evidence, models, background, ["text", "rest", "declared", "host", "suffix"])
    columns = [F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns]
    return fuse(passing, [*models], observed).filter("accepted").select(*columns)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identify the language of every document."""
    return identify_documents(table(spark, sf_dir, "documents"))

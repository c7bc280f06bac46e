"""Sanitisation of personal data by what terms reveal.

Four kinds of personal data are found by their form: these values are the entities to protect. A term that stands near
mentions of an entity can give it away all the same. How much it does is estimated from the corpus: with n
texts, of which n(c) mention the entity, n(t) have the term and n(c, t) have it within WINDOW words of a mention,

    disclosure = pointwise mutual information / information of the entity
               = log(n * n(c, t) / (n(c) * n(t))) / log(n / n(c)),

1 for a term that occurs near that entity only, 0 for an independent one. In texts that mention the entity, every
occurrence of a term at or above REMOVE is removed, at or above GENERALISE replaced by its class. Texts
that mention no entity stay as they are. A pair counts only if SUPPORT different texts hold it: copies of a text are one
observation, and any word of a text with an unheard-of address would reveal it.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Kinds of spans, in the order in which those that start together are listed.
KINDS = ("email", "ip", "card", "phone", "remove", "generalise")
BASE = 4
WINDOW = 8
SUPPORT = 2
REMOVE = 0.9
GENERALISE = 0.75
#: Different terms that a task counts before it hands the counts on.
COUNTED = 200_000

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9][0-9 -]{12,}[0-9]")
_GAP = re.compile(r"[ -]{2,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"\w+(?:['’-]\w+)*")


# ---- one text ----------------------------------------------------------------------------------


def emails(text: str) -> Iterator[tuple[int, int, str]]:
    """Every @ with a local part before it and a domain behind it. Searched from the @ signs, so that long runs of letters
    cost one look."""
    done, last = 0, -1
    for at in re.finditer("@", text):
        place = at.start()
        before = text[max(done, last + 1) : place]
        start = place - (len(before) - len(before.rstrip(_LOCAL)))
        last = place
        if start < place and (found := _DOMAIN.match(text, place + 1)):
            done = found.end()
            yield start, done, text[start:done].lower()


def addresses(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _IP.finditer(text):
        numbers = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in numbers):
            yield m.start(), m.end(), ".".join(numbers)


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int, str]]:
    """Digits with at most one space or hyphen between two of them."""
    for m in _DIGITS.finditer(text):
        start = m.start()
        for stop, begin in [*(g.span() for g in _GAP.finditer(text, m.start(), m.end())), (m.end(), m.end())]:
            digits = re.sub("[ -]", "", text[start:stop])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                yield start, stop, digits
            start = begin


def phones(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _PHONE.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 10 <= len(digits) <= 15:
            yield m.start(), m.end(), digits


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """start, kind, end and value of all personal data of a text, in order; kinds may overlap each other."""
    found = [(s, 0, e, v) for s, e, v in emails(text)] if "@" in text else []
    found += [(s, 1, e, v) for s, e, v in addresses(text)]
    found += [(s, 2, e, v) for s, e, v in cards(text)]
    found += [(s, 3, e, v) for s, e, v in phones(text)] if "+" in text else []
    return sorted(found)


def terms(text: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, int]]:
    """Start and end of the terms outside the spans, in order."""
    places, start = [], 0
    for s, _, e, _ in [*spans, (len(text), 0, len(text), "")]:
        if s > start:
            places += [m.span() for m in _TERM.finditer(text, start, s)]
        start = max(start, e)
    return places


def near(spans: list[tuple[int, int, int, str]], places: list[tuple[int, int]]) -> Iterator[tuple[str, range]]:
    """Entity of each span and the numbers of the terms within WINDOW of it."""
    at = 0
    for s, kind, _, value in spans:
        while at < len(places) and places[at][0] < s:
            at += 1
        yield f"{KINDS[kind]}:{value}", range(max(0, at - WINDOW), min(len(places), at + WINDOW))


# ---- the corpus ----------------------------------------------------------------------------------

_SPAN = "struct<start:int,kind:int,end:int>"
FOUND = (
    f"row long, doc_id long, digest binary, base array<{_SPAN}>, mentions array<struct<entity:string,terms:array<string>>>, "
    "places array<struct<term:string,start:int,end:int>>, term string, texts long"
)


def _schema() -> pa.Schema:
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    mention = pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))])
    place = pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    return pa.schema([
        ("row", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.binary()), ("base", pa.list_(span)), ("mentions", pa.list_(mention)),
        ("places", pa.list_(place)), ("term", pa.string()), ("texts", pa.int64()),
    ])


def _one(text: str, counted: Counter) -> tuple[bytes | None, list, list, list]:
    """Digest (of texts with personal data), base spans, mentions with their terms, places of these terms; counts the terms."""
    spans = base_spans(text)
    if not spans:
        counted.update(set(_TERM.findall(text.lower())) if text.isascii() else {t.lower() for t in _TERM.findall(text)})
        return None, [], [], []
    places = terms(text, spans)
    words = [text[s:e].lower() for s, e in places]
    counted.update(set(words))
    reached: dict[str, set[str]] = {}
    for entity, numbers in near(spans, places):
        reached.setdefault(entity, set()).update(words[i] for i in numbers)
    wanted = set().union(*reached.values())
    return (
        hashlib.blake2b(text.encode(), digest_size=12).digest(), [{"start": s, "kind": k, "end": e} for s, k, e, _ in spans],
        [{"entity": c, "terms": sorted(ts)} for c, ts in reached.items()],
        [{"term": w, "start": s, "end": e} for w, (s, e) in zip(words, places) if w in wanted],
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and rows with counts of terms; `row` is unique within the job."""
    schema, counted = _schema(), Counter()
    row = TaskContext.get().partitionId() << 33

    def counts():
        n, none = len(counted), lambda t: pa.nulls(len(counted), t)
        columns = [none(f.type) for f in schema][:-2] + [pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())]
        counted.clear()
        return [pa.RecordBatch.from_arrays(columns, schema=schema)] if n else []

    for batch in batches:
        texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
        found = [_one(t or "", counted) for t in texts]
        n = len(found)
        columns = [pa.array(range(row, row + n), pa.int64()), ids, *(pa.array([f[i] for f in found], schema.field(2 + i).type) for i in range(4))]
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())], schema=schema)
        row += n
        if len(counted) > COUNTED:
            yield from counts()
    yield from counts()


def scan(docs: DataFrame) -> DataFrame:
    """FOUND, written to the shared folder: rows with `row` are documents, those with `term` say in how many texts it is."""
    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scan, FOUND))


def disclosures(found: DataFrame) -> DataFrame:
    """entity, term, n_texts (different ones with both), disclosure: pairs that SUPPORT texts hold."""
    documents = found.filter("row is not null")
    n = documents.count()
    mentions = documents.select("row", "digest", F.explode("mentions").alias("m")).select("row", "digest", "m.entity", "m.terms")
    pairs = mentions.select("digest", "entity", F.explode("terms").alias("term"))
    held = (
        pairs.groupBy("entity", "term", "digest").agg(F.count("*").alias("n"))
        .groupBy("entity", "term").agg(F.count("*").alias("n_texts"), F.sum("n").alias("n_both")).filter(F.col("n_texts") >= SUPPORT)
    )
    entities = mentions.groupBy("entity").agg(F.count("*").alias("n_entity"))
    all_terms = found.filter("term is not null").groupBy("term").agg(F.sum("texts").alias("n_term"))
    log = lambda top, below: F.log(top / below)
    revealed = log(F.lit(float(n)) * F.col("n_both"), F.col("n_entity").cast("double") * F.col("n_term"))
    informed = log(F.lit(float(n)), F.col("n_entity").cast("double"))
    return (
        held.join(entities, "entity").join(all_terms, "term")
        .select("entity", "term", "n_texts", F.when(informed > 0, revealed / informed).otherwise(0.0).alias("disclosure"))
    )


def _spans(found: DataFrame) -> DataFrame:
    """row and more (spans of the terms to remove or to generalise) of the rows that have some."""
    kind = F.when(F.col("disclosure") >= REMOVE, BASE).otherwise(BASE + 1)
    told = written(disclosures(found).filter(F.col("disclosure") >= GENERALISE).select("entity", "term", kind.alias("kind")))
    documents = found.filter("row is not null")
    held = (
        documents.select("row", F.explode("mentions").alias("m")).select("row", "m.entity", F.explode("m.terms").alias("term"))
        .join(told.hint("rebalance"), ["entity", "term"]).groupBy("row", "term").agg(F.min("kind").alias("kind"))
    )
    places = documents.select("row", F.explode("places").alias("p")).select("row", "p.*")
    span = F.struct("start", F.col("kind").cast("int").alias("kind"), "end")
    return places.join(held, ["row", "term"]).groupBy("row").agg(F.collect_list(span).alias("more"))


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """row, doc_id, base, all_spans: one row per row of `docs`, whose doc_id and text are looked at.

    Spans are (start, kind, end), kind a place in KINDS, code points, end exclusive, in order; base ones (the first
    four kinds) are all in all_spans. A null text is empty and has none. Repeated rows are counted and answered one by one; null ids
    stay. Terms are runs of word characters, in lower case, outside base spans. An empty table gives no row.
    """
    found = scan(docs)
    documents = found.filter("row is not null").select("row", "doc_id", "base")
    everything = F.sort_array(F.concat("base", F.coalesce("more", F.from_json(F.lit("[]"), f"array<{_SPAN}>"))))
    return documents.join(_spans(found), "row", "left").select("row", "doc_id", "base", everything.alias("all_spans"))


def counts_and_digests(spans: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_removed, n_generalised, base_sha256, spans, from `personal_data`."""
    n = lambda kind: F.size(F.filter("all_spans", lambda s: s["kind"] == kind)).cast("long")
    names = ("n_email", "n_ip", "n_card", "n_phone", "n_removed", "n_generalised")
    return spans.select(
        "doc_id", *(n(i).alias(c) for i, c in enumerate(names)), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("all_spans")).alias("spans"),
    )


# ---- sanitised texts -------------------------------------------------------------------------------


def sanitised(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Base spans become [EMAIL] and so on (overlapping ones one mark, of the first), terms to generalise [NUMBER],
    [NAME] (capitalised) or [TERM], terms to remove nothing, with the space before them."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            kept = text[at:start]
            if kind == BASE:
                out.append(kept[:-1] if kept[-1:] == " " else kept)
            else:
                word = text[start:end]
                general = "NUMBER" if word[0].isdigit() else "NAME" if word[0].isupper() else "TERM"
                out.append(f"{kept}[{general if kind > BASE else KINDS[kind].upper()}]")
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, into: str = "sanitised") -> DataFrame:
    """`docs` with its texts sanitised in a column `into` (null where text is null)."""
    key, spans = "_row", "_spans"
    while key in docs.columns:
        key += "_"
    kept = written(docs.withColumn(key, F.monotonically_increasing_id()))
    found = personal_data(kept.select(F.col(key).alias("doc_id"), "text")).filter(F.size("all_spans") > 0)
    marked = kept.join(found.select(F.col("doc_id").alias(key), F.col("all_spans").alias(spans)), key, "left")

    @F.pandas_udf("string")
    def clean(texts, all_spans):
        return texts.combine(all_spans, lambda t, s: t if t is None or s is None else sanitised(t, [(x["start"], x["kind"], x["end"]) for x in s]))

    return marked.withColumn(into, F.when(F.col(spans).isNull(), F.col("text")).otherwise(clean("text", spans))).drop(key, spans)

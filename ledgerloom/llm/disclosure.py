"""Personal data by information-theoretic sanitisation (operator 13).

1. Protected entities are the values that four patterns find: e-mail addresses, IP addresses, card numbers and phone numbers.
2. The corpus says what else gives them away. Texts are read as passages (lines and sentences, at most ``PASSAGE`` words); a
   term is a word of three letters or digits or more, in lower case, outside the patterns' matches. The information of an entity is
   IC(e) = -ln p(e), and what a term t says of it is the pointwise mutual information PMI(t; e) = ln p(t, e) / (p(t) p(e)),
   over all passages. The disclosure PMI(t; e) / IC(e) is 1 where the term never stands without the entity; from ``DISCLOSURE``
   on the term is sanitised wherever it stands.
3. A term needs evidence: at least ``CONTEXTS`` passages that are not copies. Passages of equal words count once, and those that share
   their smallest word hash (near copies do) are one group; the effective number of contexts is the inverse of the groups' summed squared
   shares. Otherwise each word beside an address in a text of many copies would be personal data.
4. Sanitising generalises a disclosing term to the class of all words with its first ``STEM`` letters if that class discloses none of the
   entities that the term does, by the same counts; otherwise the term is removed. Matches of the patterns are replaced by their kind.

At scale: one scan counts terms and classes (one row per task and term) and emits the passages with entities; pairs of term and
entity exist for those passages only, and only for entities with enough contexts. The final scan marks words through a bit map of fixed size made of
the disclosing terms' hashes, and a join with the terms themselves settles what the map lets through; the list of terms is never
broadcast as such, and texts do not move (but in ``sanitised``, with the rows that hold a marked word).

Rows: null and empty texts have no spans; repeated rows and rows without doc_id are judged one by one; copies have equal spans;
offsets are code points, the end exclusive; overlapping matches of different kinds all count; a term's span lies outside all matches;
extra columns are ignored by ``report`` and kept by ``sanitised``; an empty table gives no rows. Ties at a threshold count as disclosing.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import materialize

KINDS = ("email", "ip", "card", "phone", "term")
DISCLOSURE, CONTEXTS, PASSAGE, STEM = 0.8, 3.0, 40, 3
_MAP_BITS, _FLUSH = 22, 200_000
_TOTAL = ""  # the "term" that every passage has

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive and from the start of a run of digits: the same matches, without trying every digit of a long run.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")
_WORD = re.compile(r"[^\W_]{3,}")
_END = re.compile(r"[.!?]\s|\n")


# --- patterns -----------------------------------------------------------------------------

def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern, each found from its ``@``, so that long words cost no more than their length."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", domain.end() if domain else at + 1)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(int(d) for d in digits[::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value without its separators) of every match, by start and then kind."""
    if not text:
        return []
    found = [(a, 0, b, text[a:b].lower()) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            found.append((m.start(), 1, m.end(), m[0]))
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end(), digits))
    for m in _PHONE.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        if 10 <= len(digits) <= 15:
            found.append((m.start(), 3, m.end(), "+" + digits))
    return sorted(found)


# --- terms and passages -------------------------------------------------------------------

def masked(text: str, spans: list[tuple[int, int, int, str]]) -> str:
    """The text with blanks in the place of the spans."""
    if not spans:
        return text
    parts, at = [], 0
    for start, _, end, _ in spans:
        if end > at:
            parts += [text[at:start], " " * (end - max(start, at))]
            at = end
    return "".join([*parts, text[at:]])


def passages(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """(start, end, distinct terms) of each passage with terms, the ends running on to the next passage's start."""
    start = 0
    for piece_end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        words = _WORD.findall(text, start, piece_end)
        if len(words) <= PASSAGE:
            if words:
                yield start, piece_end, set(map(str.lower, words))
        else:
            found = list(_WORD.finditer(text, start, piece_end))
            for lo in range(0, len(found), PASSAGE):
                end = found[lo + PASSAGE].start() if lo + PASSAGE < len(found) else piece_end
                yield start, end, set(map(str.lower, words[lo:lo + PASSAGE]))
                start = end
        start = piece_end


def class_of(term: str) -> str:
    return term[:STEM] + "*"


_EVIDENCE = "term string, n long, entity string, passage long, low long, words array<string>"


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def evidence(docs: DataFrame) -> DataFrame:
    """Counts of passages by term and class (term, n) and the passages with entities (entity, passage, low, words)."""
    def batch_of(counts: Counter, seen: list[tuple]) -> pa.RecordBatch:
        rows = [(t, n, None, None, None, None) for t, n in counts.items()] + [(None, None, *row) for row in seen]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                          names=["term", "n", "entity", "passage", "low", "words"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = Counter(), []
        for batch in batches:
            for value in batch.column("text"):
                text = value.as_py()
                if not text:
                    continue
                spans = base_spans(text)
                for start, end, words in passages(masked(text, spans)):
                    counts.update(words)
                    counts.update({class_of(w) for w in words})
                    counts[_TOTAL] += 1
                    inside = {f"{KINDS[k]}:{v}" for a, k, _, v in spans if start <= a < end} if spans else ()
                    if inside:
                        passage, low = _hash(" ".join(sorted(words))), min(map(_hash, words))
                        seen += [(entity, passage, low, sorted(words)) for entity in sorted(inside)]
                if len(counts) + len(seen) > _FLUSH:
                    yield batch_of(counts, seen)
                    counts, seen = Counter(), []
        if counts:
            yield batch_of(counts, seen)

    return docs.select("text").mapInArrow(read, _EVIDENCE)


def scored_pairs(found: DataFrame, contexts: float = CONTEXTS) -> DataFrame:
    """(entity, term, together, term_passages, entity_passages, contexts, disclosure) of the pairs with enough contexts, classes included."""
    distinct = found.where("entity IS NOT NULL").groupBy("entity", "passage", "low").agg(F.count("*").alias("n"), F.first("words").alias("words"))
    distinct = materialize(distinct, "entity-passages")
    often = (distinct.groupBy("entity").agg(F.sum("n").alias("entity_passages"), F.count("*").alias("__")).where(F.col("__") >= contexts).drop("__"))
    classes = F.transform("words", lambda w: F.concat(F.substring(w, 1, STEM), F.lit("*")))
    pairs = (distinct.join(often, "entity").select("entity", "entity_passages", "low", "n", F.explode(F.array_union("words", classes)).alias("term"))
             .groupBy("entity", "entity_passages", "term", "low").agg(F.sum("n").alias("n"), F.count("*").cast("double").alias("group"))
             .groupBy("entity", "entity_passages", "term").agg(
                 F.sum("n").alias("together"), (F.sum("group") * F.sum("group") / F.sum(F.col("group") * F.col("group"))).alias("contexts"))
             .where(F.col("contexts") >= contexts))
    pairs = materialize(pairs, "entity-terms")
    # Of all the counts only those of paired terms are added up, so few of them are shuffled.
    counts = (found.where("term IS NOT NULL").join(pairs.select("term").distinct(), "term", "left_semi")
              .groupBy("term").agg(F.sum("n").alias("term_passages")))
    total = found.where(F.col("term") == _TOTAL).agg(F.sum("n")).first()[0] or 0
    share = lambda n: F.log(F.lit(float(total)) / F.col(n))  # noqa: E731  the information of an event that n passages have
    mutual = F.log(F.col("together") * F.lit(float(total)) / (F.col("term_passages") * F.col("entity_passages").cast("double")))
    return pairs.join(counts, "term").select(
        "entity", "term", "together", "term_passages", "entity_passages", "contexts",
        F.when(F.col("entity_passages") < total, mutual / share("entity_passages")).alias("disclosure"))


def disclosing_terms(docs: DataFrame, disclosure: float = DISCLOSURE, contexts: float = CONTEXTS) -> DataFrame:
    """(term, disclosure, entities, replacement): the terms that give entities away, and the class that stands for each (empty: removed).

    ``disclosure`` is the largest one, ``entities`` the number of entities that the term discloses.
    """
    scored = materialize(scored_pairs(materialize(evidence(docs), "disclosure-evidence"), contexts), "disclosure-pairs")
    is_class = F.col("term").endswith("*")
    risky = scored.where(~is_class & (F.col("disclosure") >= disclosure)).select(
        "entity", "term", "disclosure", F.concat(F.substring("term", 1, STEM), F.lit("*")).alias("class"))
    classes = scored.where(is_class).select("entity", F.col("term").alias("class"), F.col("disclosure").alias("of_class"))
    judged = risky.join(classes, ["entity", "class"], "left").groupBy("term", "class").agg(
        F.max("disclosure").alias("disclosure"), F.count("*").alias("entities"), F.max("of_class").alias("of_class"))
    tells = (F.coalesce("of_class", F.lit(0.0)) >= disclosure) | (F.length("term") <= STEM)
    return materialize(judged.select("term", "disclosure", "entities", F.when(tells, "").otherwise(F.col("class")).alias("replacement")), "disclosing-terms")


# --- spans --------------------------------------------------------------------------------

def _bit(term: str) -> int:
    return zlib.crc32(term.encode()) & ((1 << _MAP_BITS) - 1)


def term_map(terms: DataFrame) -> np.ndarray | None:
    """A bit for each term's hash, at most 2 ** _MAP_BITS of them however many terms there are; nothing if there are none."""
    bit = F.crc32(F.col("term").cast("binary")).bitwiseAND((1 << _MAP_BITS) - 1)
    placed = terms.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, cast(crc32(cast(term AS binary)) & 63 AS int))").alias("bits"))
    rows = placed.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()  # one row per 64 bits of the map
    if not rows:
        return None
    out = np.zeros(1 << (_MAP_BITS - 6), dtype=np.int64)
    out[[r["word"] for r in rows]] = [r["bits"] for r in rows]
    return np.unpackbits(out.view(np.uint8), bitorder="little")


_SPANS = "array<struct<start:int,kind:int,end:int>>"
_MARKED = "array<struct<term:string,start:int,end:int>>"


def marked(docs: DataFrame, bits: np.ndarray | None) -> DataFrame:
    """``docs`` with ``base``, the patterns' spans, and ``marked``, the words that the map lets through, for columns that do not clash."""
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(f"base {_SPANS}, marked {_MARKED}").fields])
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    word = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        for batch in batches:
            base, words = [], []
            for value in batch.column("__text"):
                text = value.as_py() or ""
                spans = base_spans(text)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b, _ in spans])
                hits = []
                if bits is not None:
                    for m in _WORD.finditer(masked(text, spans)):
                        hit = known.get(m[0])
                        if hit is None:
                            if len(known) > _FLUSH:
                                known.clear()
                            hit = known[m[0]] = bool(bits[_bit(m[0].lower())])
                        if hit:
                            hits.append({"term": m[0].lower(), "start": m.start(), "end": m.end()})
                words.append(hits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base, span), pa.array(words, word)], names=[*batch.schema.names, "base", "marked"])

    return docs.mapInArrow(mark, schema)


def _with_terms(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``docs`` (with ``__text``) with base and ``terms``, the disclosing terms' places, as an array of (start, end, replacement)."""
    found = materialize(marked(docs, term_map(terms)).withColumn("__row", F.monotonically_increasing_id()), "disclosure-spans")
    hits = found.select("__row", F.explode("marked").alias("hit")).select("__row", "hit.*").join(terms.select("term", "replacement"), "term")
    by_row = hits.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "replacement"))).alias("terms"))
    none = F.array().cast("array<struct<start:int,end:int,replacement:string>>")
    return found.drop("marked").join(by_row, "__row", "left").withColumn("terms", F.coalesce("terms", none)).drop("__row")


def spans(docs: DataFrame, disclosure: float = DISCLOSURE, contexts: float = CONTEXTS) -> DataFrame:
    """(doc_id, spans): every span of a row as (start, kind number, end), by start and kind."""
    terms = disclosing_terms(docs, disclosure, contexts)
    found = _with_terms(docs.select("doc_id", F.col("text").alias("__text")), terms)
    extra = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("term")).alias("kind"), t["end"].alias("end")))
    return found.select("doc_id", F.sort_array(F.concat("base", extra)).alias("spans"))


def report(docs: DataFrame, disclosure: float = DISCLOSURE, contexts: float = CONTEXTS) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of ``docs`` (doc_id, text)."""
    names = F.array(*map(F.lit, KINDS))
    line = lambda found: F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    term = KINDS.index("term")
    of_kind = lambda i: F.filter("spans", lambda s: s["kind"] == i)
    base = F.filter("spans", lambda s: s["kind"] != term)
    return spans(docs, disclosure, contexts).select(
        "doc_id", *(F.size(of_kind(i)).cast("long").alias(f"n_{KINDS[i]}") for i in range(term)),
        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def _edited(text: str | None, base: list[dict], terms: list[dict]) -> str | None:
    """The text with every span replaced; of overlapping matches the first one is named and all are covered."""
    if text is None:
        return None
    edits = [(s["start"], s["end"], f"[{KINDS[s['kind']].upper()}]") for s in base] + [(t["start"], t["end"], t["replacement"]) for t in terms]
    parts, at = [], 0
    for start, end, new in sorted(edits):
        if start >= at:
            parts += [text[at:start], new]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def sanitised(docs: DataFrame, disclosure: float = DISCLOSURE, contexts: float = CONTEXTS) -> DataFrame:
    """``docs`` with all columns: matches replaced by their kind in brackets, disclosing terms by their class (``abc*``) or by nothing."""
    terms = disclosing_terms(docs, disclosure, contexts)
    found = _with_terms(docs.select(F.struct("*").alias("__all"), F.col("text").alias("__text")), terms)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_edited(*(c.as_py() for c in row)) for row in zip(*(batch.column(c) for c in ("__text", "base", "terms")))]
            yield pa.RecordBatch.from_arrays([batch.column("__all"), pa.array(texts, pa.string())], names=["__all", "__clean"])

    done = found.mapInArrow(clean, T.StructType([found.schema["__all"], T.StructField("__clean", T.StringType())]))
    return done.select(*(F.col("__clean" if c == "text" else f"__all.`{c}`").alias(c) for c in docs.columns))

"""Operator 5: PII surrogates, keyed, type-consistent and checked for collisions.

Detected entities (mail addresses, IPv4 addresses, phone numbers, card-like numbers, social security numbers, IBANs,
names after an honorific) are replaced. A surrogate is drawn by a keyed hash of the entity's canonical form, so
the same entity gets the same surrogate everywhere (coreference), in the shape it had: letters and digits are
replaced by letters and digits in place, separators stay, check digits and private address ranges stay as
valid or private as they were, mail addresses of one domain share the new domain, names keep gender and script.

Collision check over the whole corpus: if two entities draw one surrogate, or a surrogate is itself an entity of the
corpus, all but the first draw again with a counter, until every surrogate is distinct and new. A corpus may hold as
many entities as there are surrogates of a shape, so after every ``WIDEN_AFTER`` draws a surrogate gets one more
syllable, letter or digit (an address becomes an IPv6 one, of the same privacy): the space always outgrows the
entities and the redraws end. Redraws reach the documents through a join on doc_id, of any size.

Defined results: NULL text stays NULL, empty text stays empty, texts without an entity stay as they are; repeated rows
are rewritten alike; ties for a surrogate go to the entity that sorts first; NULL doc_id is kept and rewritten
alike; all other columns pass through (``n_chars``, if there, follows the new text); clashing names do no harm,
as the join carries only columns with names of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, column, keep, table

# fixed values: honorifics by gender
MALE = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "госпожа"]
EITHER = ["Dr", "Prof"]

ENTITY = re.compile(
    r"(?P<email>[\w.%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.-])(?:\d{4}[ -]){3}\d{1,7}(?![\w-])|(?<![\w.-])\d{13,19}(?!\w|\.\d))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?:[ .-]\d{2,4})?(?!\w)"
    r"|(?<!\w)\+\d{9,14}(?!\w))"
    r"|\b(?P<title>" + "|".join(MALE + FEMALE + EITHER) + r")\.? (?P<name>[^\W\d_a-zа-я]\w+(?: [^\W\d_a-zа-я]\w+)?)")
#: a text without a match of this has no entity
HINT = re.compile(r"@|\d\.\d|\d{9}|\d[ .-]\d|\(\d|\d-\d|[A-Z]{2}\d\d|\b(?:" + "|".join(MALE + FEMALE + EITHER) + r")\b")


WIDEN_AFTER = 4   # draws of one size; each further such number of draws makes a surrogate longer by one


@dataclass(frozen=True)
class PiiConfig:
    key: bytes = b"surrogates-1"   # secret of the keyed hash; set your own


def canonical(kind: str, value: str) -> str:
    """What makes two mentions the same entity."""
    if kind in ("card", "phone", "ssn"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    return value.lower() if kind == "email" else value


_WORD = re.compile(r"[^\W\d_]\w*")


def mentions(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of a text's entities, leftmost first, without overlaps.

    A name is one entity of its document whatever its title: its gender is that of its gendered mentions (the first
    one decides), and where it stands again without a title it is the same entity.
    """
    if not text or not HINT.search(text):
        return []
    out, sexes = [], {}
    for m in ENTITY.finditer(text):
        kind = m.lastgroup
        if kind == "name":
            title, name = m["title"], m["name"]
            sex = "m" if title in MALE else "f" if title in FEMALE else "n"
            if sexes.get(name, "n") == "n":
                sexes[name] = sex
            out.append((m.start("name"), m.end("name"), "name", name))
        else:
            out.append((m.start(), m.end(), kind, canonical(kind, m[0])))
    if not sexes:
        return out
    for a, b, name in _again(text, sexes):
        out.append((a, b, "name", name))
    out.sort(key=lambda x: (x[0], -x[1]))
    kept, end = [], 0
    for x in out:
        if x[0] >= end:
            kept.append((x[0], x[1], "name-" + sexes[x[3]], x[3]) if x[2] == "name" else x)
            end = x[1]
    return kept


def _again(text: str, names: dict) -> list[tuple[int, int, str]]:
    """Places where the names stand as whole words: one pass over the words, the longer of two names first."""
    first: dict[str, list[str]] = {}
    for n in names:
        first.setdefault(n.split(" ")[0], []).append(n)
    out = []
    for m in _WORD.finditer(text):
        for n in sorted(first.get(m[0], ()), key=len, reverse=True):
            end = m.start() + len(n)
            if text.startswith(n, m.start()) and not (end < len(text) and (text[end].isalnum() or text[end] == "_")):
                out.append((m.start(), end, n))
                break
    return out


class Draw:
    """Numbers below a bound, one after the other, from a keyed hash of what they are for."""

    def __init__(self, key: bytes, *what: str):
        self.seed = hmac.new(key, "\x1f".join(what).encode(), hashlib.sha256).digest()
        self.count, self.pool = 0, 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 64:
            self.pool = self.pool << 256 | int.from_bytes(
                hashlib.sha256(self.seed + self.count.to_bytes(8, "big")).digest(), "big")
            self.count += 1
        self.pool, out = divmod(self.pool, n)
        return out


def luhn(digits: str) -> bool:
    d = [int(c) for c in digits]
    return sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(reversed(d))) % 10 == 0


_SCRIPTS = {  # vowels and consonants that names are spelt with
    "latin": ("aeiou", "bdfgklmnprstvz"), "cyrillic": ("аеиоу", "бвгдклмнпрст"), "greek": ("αειου", "βγδκλμνπρστ")}
#: first and last code point of the letters of scripts without capitals, from which a letter is drawn
_RANGES = [("ا", "غ"), ("ف", "ي"), ("א", "ת"), ("ぁ", "ん"), ("ァ", "ン"), ("一", "龥"), ("가", "힣"), ("अ", "ह"), ("ก", "ฮ")]


def _alike(d: Draw, c: str) -> str:
    """A letter of the script and case of ``c``."""
    for low, high in _RANGES:
        if low <= c <= high:
            return chr(ord(low) + d.below(ord(high) - ord(low) + 1))
    low = c.lower()
    x = (chr(ord("а") + d.below(32)) if "а" <= low <= "ӿ" else chr(ord("α") + d.below(17)) if "ά" <= low <= "ώ"
         else "abcdefghijklmnopqrstuvwxyz"[d.below(26)])
    return x.upper() if c.isupper() else x


def _letters(d: Draw, text: str) -> str:
    """Letters for letters and digits for digits, in the same script and case; other characters stay."""
    return "".join(str(d.below(10)) if c.isdigit() else _alike(d, c) if c.isalpha() else c for c in text)


def _name(d: Draw, name: str, sex: str, more: int = 0) -> str:
    first = name[0]
    if any(low <= first <= high for low, high in _RANGES):  # no vowels and capitals to keep: letters of the script
        return " ".join(_letters(d, w + w[-1] * more) for w in name.split(" "))
    script = "cyrillic" if "Ѐ" <= first <= "ӿ" else "greek" if "Ͱ" <= first <= "Ͽ" else "latin"
    vowels, consonants = _SCRIPTS[script]
    words = []
    for k, w in enumerate(name.split(" ")):
        s = "".join(consonants[d.below(len(consonants))] + vowels[d.below(len(vowels))]
                    for _ in range(max(2, min(4, (len(w) + 1) // 2)) + more))
        if not k and sex != "n":  # given names end by gender: a vowel a, or a consonant
            s = s[:-1] + (vowels[0] if sex == "f" else vowels[1] + consonants[d.below(len(consonants))])
        words.append(s.upper() if w.isupper() and len(w) > 1 else s.capitalize())
    return " ".join(words)


def surrogate(kind: str, canon: str, attempt: int, key: bytes) -> str:
    """The replacement of an entity in canonical form."""
    d = Draw(key, kind, canon, str(attempt))
    more = attempt // WIDEN_AFTER
    if kind in ("card", "phone", "ssn"):
        s = "".join(str(1 + d.below(9)) if not i and c != "0" else "0" if not i else str(d.below(10))
                    for i, c in enumerate(canon + "1" * more))
        if kind == "card":
            last = next(x for x in "0123456789" if luhn(s[:-1] + x))
            s = s[:-1] + (last if luhn(canon) else str((int(last) + 1 + d.below(9)) % 10))
        return s
    if kind == "ip":
        private = ipaddress.ip_address(canon).is_private
        if more > 2:  # there is no longer IPv4 address
            return ("fd" if private else "2a") + ":".join([f"{d.below(256):02x}"] + [f"{d.below(1 << 16):04x}" for _ in range(7)])
        if private:
            return f"10.{d.below(256)}.{d.below(256)}.{1 + d.below(254)}"
        first = [x for x in range(11, 224) if x not in (100, 127, 169, 172, 192, 198, 203)]
        return f"{first[d.below(len(first))]}.{d.below(256)}.{d.below(256)}.{1 + d.below(254)}"
    if kind == "email":
        local, domain = canon.rsplit("@", 1)
        host, top = domain.rsplit(".", 1)
        return _letters(d, local + "a" * more) + "@" + _letters(Draw(key, "domain", domain), host) + "." + top
    if kind == "iban":
        return canon[:2] + _letters(d, canon[2:] + "1" * more)
    return _name(d, canon, kind[-1], more)


def in_shape(kind: str, value: str, new: str) -> str:
    """The canonical surrogate in the shape of the mention: separators and capitals where they were, more at the end."""
    if kind in ("card", "phone", "ssn", "iban"):
        it = iter(new)
        return "".join(next(it) if c.isalnum() else c for c in value) + "".join(it)
    if kind == "email" and len(new) == len(value):
        return "".join(n.upper() if c.isupper() else n for c, n in zip(value, new))
    return new


def rewrite(text: str, found: list, key: bytes, attempts: dict[tuple[str, str], int] | None = None) -> str:
    out, at = [], 0
    for a, b, kind, canon in found:
        n = attempts.get((kind, canon), 0) if attempts else 0
        out += [text[at:a], in_shape(kind, text[a:b], surrogate(kind, canon, n, key))]
        at = b
    return "".join([*out, text[at:]])


def entities(docs: DataFrame) -> DataFrame:
    """(key, kind, canon): the distinct entities of each text; a text's key is its hash."""
    def run(batches):
        for b in chunks(batches):
            rows = [(i, k, c) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for k, c in dict.fromkeys(x[2:] for x in mentions(t))]
            if rows:
                cols = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string()))],
                    names=["key", "kind", "canon"])

    return docs.select(F.xxhash64("text").alias("key"), "text").mapInArrow(run, "key long, kind string, canon string")


def redraws(distinct: DataFrame, cfg: PiiConfig) -> DataFrame | None:
    """(kind, canon, attempt) of the entities that must draw again; None if there are none."""
    spark, key = distinct.sparkSession, cfg.key

    def draw(df: DataFrame) -> DataFrame:
        def run(batches):
            for b in batches:
                k, c, n = (x.to_pylist() for x in b.columns)
                s = [surrogate(*x, key) for x in zip(k, c, n)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.string())],
                                                 names=["kind", "canon", "attempt", "sur"])

        return df.select("kind", "canon", "attempt").mapInArrow(run, "kind string, canon string, attempt int, sur string")

    now = keep(spark, draw(distinct.withColumn("attempt", F.lit(0))), "surrogates")
    # what is read as one kind of thing is kept apart as one: names of all genders, all runs of digits
    family = F.when(F.col("kind").startswith("name"), F.lit("name")).when(
        F.col("kind").isin("card", "phone", "ssn"), F.lit("digits")).otherwise(F.col("kind"))
    real = distinct.select(family.alias("_k"), F.col("canon").alias("_c")).distinct()
    who = F.struct("kind", "canon")
    while True:
        now_ = now.withColumn("family", family)
        twice = now_.groupBy("family", "sur").agg(F.count(F.lit(1)).alias("n"), F.min(who).alias("first")).filter("n > 1")
        late = now_.join(twice, ["family", "sur"]).filter(who != F.col("first")).select("kind", "canon")
        taken = now_.join(real, (F.col("family") == F.col("_k")) & (F.col("sur") == F.col("_c")), "left_semi")
        bad = keep(spark, late.unionByName(taken.select("kind", "canon")).distinct(), "redraw")
        if bad.isEmpty():
            changed = now.filter("attempt > 0").select("kind", "canon", "attempt")
            return None if changed.isEmpty() else changed
        again = draw(now.join(bad, ["kind", "canon"]).withColumn("attempt", F.col("attempt") + 1))
        now = keep(spark, now.join(bad, ["kind", "canon"], "left_anti").unionByName(again), "surrogates")


def replace(docs: DataFrame, cfg: PiiConfig = PiiConfig(), counts: bool = False) -> DataFrame:
    """``docs`` with every entity replaced; with ``counts`` also n_entities and kinds."""
    spark, key = docs.sparkSession, cfg.key
    of_docs = keep(spark, entities(docs), "entities")
    again = redraws(of_docs.select("kind", "canon").distinct(), cfg)
    cols, redrawn = docs.columns, again is not None
    src = docs
    if again is not None:
        # the redraws of each text's own entities, however many documents have the text; Spark broadcasts them if
        # they are small enough
        per_text = of_docs.distinct().join(again, ["kind", "canon"]).groupBy(F.col("key").alias("_pii_key")).agg(
            F.collect_set(F.struct("kind", "canon", "attempt")).alias("_pii_redraw"))
        src = docs.join(per_text, F.xxhash64("text") == F.col("_pii_key"), "left").drop("_pii_key")
    at, long = cols.index("text"), cols.index("n_chars") if "n_chars" in cols else None
    kinds = [*docs.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds)
    names = [*cols, "n_entities", "kinds"] if counts else cols

    def run(batches):
        for b in chunks(batches, at):
            texts = b.column(at).to_pylist()
            more = b.column(len(cols)).to_pylist() if redrawn else [None] * len(texts)
            found = [mentions(t) for t in texts]
            new = [rewrite(t, f, key, {(x["kind"], x["canon"]): x["attempt"] for x in r} if r else None) if f else t
                   for t, f, r in zip(texts, found, more)]
            out = list(b.columns[: len(cols)])
            out[at] = pa.array(new, pa.string())
            if long is not None:
                old = out[long]
                out[long] = pa.array([len(x) if x is not None and f else o.as_py()
                                      for x, f, o in zip(new, found, old)], old.type)
            if counts:
                out += [pa.array([len(f) for f in found], pa.int32()),
                        pa.array([",".join(sorted({x[2] for x in f})) for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return src.mapInArrow(run, schema + (", n_entities int, kinds string" if counts else ""))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace(docs, counts=True)

"""Personal data replaced by keyed surrogates of the same kind.

1. Patterns find entities; a name is the words behind one or more titles, each word an entity of its own, so
   that "Mrs Ada Lang" and "Ms Lang" keep the surname in common. A second pass over the text finds where it
   repeats such a name without a title. Small words ("von") stay.
2. The distinct entities of the corpus get surrogates from a keyed hash: same entity, same surrogate
   everywhere. A name is one entity, whatever its titles say; role and gender are attributes on which all
   its occurrences agree. Rounds of joins check the surrogates: one that another entity has, or that is
   itself an entity of the corpus, is drawn again. All names share one space, so persons stay distinct.
3. Spans get their surrogates by a join on the entity and texts by a join on their digest. Only texts
   that may hold an entity take part; all others pass through unshuffled.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.llm.common import portions, table
from glyphvec.session import materialise, settled

#: Titles by the gender they tell; the last ones tell none.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "Κυρία")
OTHER = ("Dr", "Prof", "Doctor", "Professor")
#: Names to draw from, by script and gender.
GIVEN = {
    ("latin", "male"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Louis Martin Noel Oscar Paul Rafael Simon Tomas Victor".split(),
    ("latin", "female"): "Alma Bella Clara Diana Elena Flora Greta Helena Irene Julia Karin Laura Marta Nora Olga Paula Rosa Sonia Teresa Vera".split(),
    ("cyrillic", "male"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Сергей".split(),
    ("cyrillic", "female"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Раиса Софья".split(),
    ("greek", "male"): "Άρης Γιώργος Δημήτρης Θάνος Κώστας Λεωνίδας Μάρκος Νίκος Πέτρος Στέφανος".split(),
    ("greek", "female"): "Άννα Βάσω Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία Χριστίνα".split(),
}
SURNAMES = {
    "latin": "Abel Berger Castell Dorn Ebner Falk Garnier Hollis Iversen Jansen Keller Lindt Marlow Norden Orlan Pascal Quint Roth Sander Tellier Ulmer Vance Weber Yates Zeller".split(),
    "cyrillic": "Авилов Белов Власов Громов Дубов Ершов Жилин Зуев Карпов Лавров Минин Носов Орлов Панин Рогов".split(),
    "greek": "Αλεξίου Βλάχος Γεωργίου Δήμου Ζαφείρης Ιωάννου Κανάκης Λάμπρου Μανώλης Νικολάου Παππάς Ρούσσος".split(),
}


def _class(*categories: str) -> str:
    """The characters of some Unicode categories, as ranges for a pattern's brackets."""
    ranges, start = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c)) in categories and chr(c) not in "ªº"
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            ranges.append(f"{chr(start)}-{chr(c - 1)}" if start < c - 1 else chr(start))
            start = None
    return "".join(ranges)


#: Letters that may begin a name: capitals, and letters of scripts without them.
_FIRST = f"[{_class('Lu', 'Lt', 'Lo')}]"
_MARK = f"[{_class('Mn', 'Mc')}]"
_LETTER = rf"(?:[^\W\d_]{_MARK}*)"
_GAP = r"[ \t\xa0\u202f]"
_QUOTE, _HYPHEN = "['’ʼ]", "[-‐‑]"
#: One word of a name, without the 's of a genitive: Lang, McDonald, O'Brien, Anne-Marie, d'Arc, al-Amin.
_WORD = (
    rf"(?:(?:d|l|t|dell|dall|nell){_QUOTE}|(?:al|el|ul|an|ar|as|at|ad|az){_HYPHEN})?"
    rf"{_FIRST}{_MARK}*{_LETTER}*(?:(?!{_QUOTE}s(?![^\W_]))(?:{_QUOTE}|{_HYPHEN}){_LETTER}+)*(?![^\W_])"
)
#: Small words within a name.
_SMALL = (
    r"(?:von und zu|vom und zum|van der|van den|van de|von der|von dem|von den|de los|de las|de la|de le|de|del|della|"
    r"dei|degli|di|da|das|do|dos|du|des|den|der|ter|ten|von|vom|van|af|av|bin|ibn|bint|ben|abu|y|e|i)"
)
_LEADING = rf"(?:{_SMALL}|zu|zum|zur|la|le|el|al|te)"
_INITIALS = rf"{_FIRST}{_MARK}*\.(?:{_HYPHEN}?{_FIRST}{_MARK}*\.)*"
_PART = rf"(?:{_INITIALS}(?={_GAP}*(?:{_LEADING}{_GAP}+)?{_FIRST})|{_WORD})"
_NAMES = (
    rf"(?:{_LEADING}{_GAP}+)?(?:{_PART}(?:{_GAP}+(?:{_SMALL}{_GAP}+)?{_PART}|(?<=\.){_GAP}*{_PART})*|{_INITIALS})"
)
#: What may follow a name and is none.
_SUFFIXES = ("Jr", "Sr", "II", "III", "IV")
#: Degrees that stand behind a title.
_DEGREE = r"(?:(?:med|dent|vet|phil|jur|iur|rer|nat|ing|h|c|hc|habil|oec|pol|theol|mult|Ing)\.[ \t -]*)"
_TITLES = "|".join(sorted((*MALE, *FEMALE, *OTHER), key=len, reverse=True))
#: What the part of an address before the @ is made of.
_LOCAL = r"[\w.!#$%&'*+/=?^`{|}~-]"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ENTITY = re.compile(
    rf"(?P<email>(?:\"(?:[^\"\\\n]|\\.)+\"|(?<!{_LOCAL}){_LOCAL}+)@(?:[\w-]+(?:\.[\w-]+)+|\[[0-9A-Fa-fIPv.:]+\]))"
    rf"|(?P<ip>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d))"
    r"|(?P<ip6>(?<![\w:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:]))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+.])(?:\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,6}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"
    r"|\(?0\d{1,4}\)?[ /-] ?\d{2,8}(?:[ -]?\d{2,4}){0,4})(?!\w))"
    r"|(?P<number>(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w))"
    rf"|(?P<person>(?<!\w)(?P<titles>(?:(?:{_TITLES})(?:\.?{_GAP}+|\.{_GAP}*|\.-){_DEGREE}*)+)(?P<names>{_NAMES}))"
)
#: Digits of a phone number; numbers that begin with a nought have more than a date.
PHONE_DIGITS, NATIONAL_DIGITS = range(7, 20), range(9, 14)
#: Texts without this hold no entity; whatever ``find`` finds has it.
MAYBE = (
    rf"@|\p{{Nd}}[\p{{Nd}} .()/-]{{5,}}\p{{Nd}}|[A-Z]{{2}}\p{{Nd}}{{2}}|:[0-9A-Fa-f]{{0,4}}:"
    rf"|(?:{_TITLES})(?:\.|[ \t\u00a0\u202f])"
)

SPAN = "struct<start: int, end: int, kind: string, canon: string>"


def _script(word: str) -> str:
    first = ord(word[0])
    return "greek" if 0x370 <= first < 0x400 else "cyrillic" if 0x400 <= first < 0x530 else "latin"


def _luhn(digits: str) -> int:
    """Check sum modulo 10; 0 if the last digit fits the others."""
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10


def _folded(name: str) -> str:
    return unicodedata.normalize("NFC", name).replace("’", "'").replace("ʼ", "'").lower()


def _address(shown: str) -> str:
    """An IPv6 address written in full; empty if it is none, or a mere scope such as ``a::b``."""
    try:
        full = ipaddress.IPv6Address(shown).exploded
    except ValueError:
        return ""
    return full if any(c.isdigit() for c in shown) and len(shown) > 5 else ""


def _iban_check(canon: str) -> str:
    """The check digits (ISO 7064, modulo 97) of an account number."""
    moved = canon[4:] + canon[:2] + "00"
    return f"{98 - int(''.join(str(int(c, 36)) for c in moved)) % 97:02}"


_TITLE = re.compile(rf"(?<!\w)(?:{_TITLES})(?!\w)")
_PIECE = re.compile(rf"(?P<initials>{_INITIALS}(?={_GAP}*(?:{_LEADING}{_GAP}+)?{_FIRST}|$))|(?P<word>{_WORD})|(?P<small>{_LETTER}+)")
_MENTION = re.compile(rf"(?<!\w){_WORD}")
_SUBWORD = re.compile(rf"{_LETTER}+")


def _named(m: re.Match) -> list[tuple[int, int, str, str]]:
    """The words of a name behind titles. The last word, and words behind a small one, are surnames."""
    told = {"male" if t in MALE else "female" for t in _TITLE.findall(m.group("titles")) if t not in OTHER}
    gender = told.pop() if len(told) == 1 else "any"
    pieces = list(_PIECE.finditer(m.group("names")))
    pieces = [p for k, p in enumerate(pieces) if k == 0 or p.group() not in _SUFFIXES]
    last = max(k for k, p in enumerate(pieces) if not p["small"])
    spans, family = [], False
    for k, p in enumerate(pieces):
        if p["small"]:
            family = True
            continue
        script = _script(p.group())
        joint = k + 1 < len(pieces) and pieces[k + 1].group() in ("y", "e", "i")
        role = f"surname-{script}" if family or joint or k == last else f"given-{script}-{gender}"
        canon = _folded(p.group())
        spans.append((m.start("names") + p.start(), m.start("names") + p.end(), role, canon.rstrip(".")))
    return spans


def _mentions(text: str, spans: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Words of ``text`` outside ``spans`` that are names behind a title elsewhere in it.

    A name found in several roles stands for the first of them. Parts of words with hyphens count, and the
    German genitive; initials do not, nor words in small letters.
    """
    known: dict[str, str] = {}
    for _, _, kind, canon in spans:
        if kind.startswith(("given-", "surname-")) and (len(canon) > 1 or unicodedata.category(canon) == "Lo"):
            known.setdefault(canon, kind)
    if not known:
        return []
    found, at = [], 0

    def note(start: int, end: int) -> bool:
        canon = _folded(text[start:end])
        if canon not in known and len(canon) > 3 and canon.endswith("s"):
            canon, end = canon[:-1], end - 1
        if canon in known:
            found.append((start, end, known[canon], canon))
        return canon in known

    for m in _MENTION.finditer(text):
        while at < len(spans) and spans[at][1] <= m.start():
            at += 1
        if at < len(spans) and spans[at][0] < m.end():
            continue
        if not note(m.start(), m.end()):
            for part in _SUBWORD.finditer(text, m.start(), m.end()):
                if part.end() - part.start() < m.end() - m.start() and part.group()[0] == part.group()[0].upper():
                    note(part.start(), part.end())
    return found


def find(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the entities of ``text``, in order; end exclusive.

    A second pass over the text adds the mentions without a title of the names that the first one found.
    """
    spans = []
    for m in ENTITY.finditer(text or ""):
        shown, start = m.group(), m.start()
        if m.group("person"):
            spans += _named(m)
            continue
        kind = next(k for k in ("email", "ip", "ip6", "iban", "ssn", "phone", "number") if m.group(k))
        if kind == "email":
            if shown[0] != '"':
                start += len(shown) - len(shown.lstrip(".!#$%&'*/=?^`{|}~-"))
            if text[start] == "@":
                continue
            canon = text[start : m.end()].lower()
        elif kind == "ip":
            canon = shown
        elif kind == "ip6":
            canon = _address(shown)
            if not canon:
                continue
        elif kind == "phone":
            canon = re.sub(r"[^\d+]", "", shown)
            national = canon[0] == "0" and not re.fullmatch(r"\d{3}[.-]\d{3}[.-]\d{4}", shown)
            if len(canon.lstrip("+")) not in (NATIONAL_DIGITS if national else PHONE_DIGITS):
                continue
        else:
            canon = re.sub(r"[^0-9A-Z]", "", shown)
        spans.append((start, m.end(), kind, canon))
    return sorted(spans + _mentions(text or "", spans))


def _stream(key: bytes, *what: object) -> Iterator[int]:
    """Endless bytes that depend on the key and on ``what``."""
    seed = "\0".join(map(str, what)).encode("utf-8", "surrogatepass")
    block = 0
    while True:
        yield from hmac.new(key, seed + b"\0%d" % block, hashlib.sha256).digest()
        block += 1


def _mapped(chars: str, stream: Iterator[int]) -> str:
    """Letters for letters, digits for digits; everything else stays."""
    out = []
    for c in chars:
        if c.isdigit():
            out.append(str((next(stream) << 8 | next(stream)) % 10))
        elif c.isalpha():
            letter = chr(ord("a") + (next(stream) << 8 | next(stream)) % 26)
            out.append(letter.upper() if c.isupper() else letter)
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, canon: str, attempt: int = 0) -> str:
    """Stand-in for an entity, in canonical form. Late attempts may be longer, so that one is free."""
    stream = _stream(key, kind, canon, attempt)
    extra = max(0, attempt - 3)
    if kind == "email":
        local, _, domain = canon.rpartition("@")
        labels, _, top = domain.rpartition(".")
        return f"{_mapped(local + 'x' * extra, stream)}@{_mapped(labels, _stream(key, 'domain', domain))}.{top}"
    if kind == "ip":
        a, b, c, d = (next(stream) for _ in range(4))
        return f"{1 + a % 223}.{b}.{c}.{1 + d % 254}"
    if kind == "ip6":
        return ipaddress.IPv6Address(bytes([0x20, *(next(stream) for _ in range(15))])).exploded
    if kind == "iban":
        drawn = canon[:4] + _mapped(canon[4:] + "0" * extra, stream).upper()
        return canon[:2] + _iban_check(drawn) + drawn[4:] if _iban_check(canon) == canon[2:4] else drawn
    if kind == "phone":
        kept = 3 if canon.startswith("+") else 0
        return canon[:kept] + _mapped(canon[kept:] + "0" * extra, stream)
    if kind == "ssn":
        return _mapped(canon + "0" * extra, stream)
    if kind == "number":
        drawn = canon[0] + _mapped(canon[1:] + "0" * extra, stream)
        if _luhn(canon) == 0:
            drawn = drawn[:-1] + str((int(drawn[-1]) - _luhn(drawn)) % 10)
        return drawn
    role, script, *gender = kind.split("-")
    if role == "surname":
        names = SURNAMES[script]
    else:
        both = [n for g in ("male", "female") for n in GIVEN[script, g]]
        names = both if gender == ["any"] else GIVEN[script, gender[0]]
    parts = (names[(next(stream) << 8 | next(stream)) % len(names)] for _ in range(1 + attempt // 2))
    return "-".join(parts).lower()


def dressed(shown: str, kind: str, canon: str) -> str:
    """The surrogate ``canon`` in the format of the replaced text ``shown``."""
    if kind in ("iban", "phone", "ssn", "number"):
        rest = iter(canon)
        kept = "".join(next(rest, "") if c.isalnum() or c == "+" else c for c in shown)
        return kept + "".join(rest)
    if kind == "email":
        return canon.upper() if shown.isupper() else canon
    if kind == "ip":
        return canon
    if kind == "ip6":
        short = canon if len(shown) == 39 else ipaddress.IPv6Address(canon).compressed
        return short.upper() if shown.isupper() else short
    return canon.upper() if shown.isupper() and len(shown.rstrip(".")) > 1 else "-".join(p.capitalize() for p in canon.split("-"))


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``, the entities of the text; an empty list for null and empty texts."""

    @F.arrow_udf(f"array<{SPAN}>")
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(
            pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("canon", pa.string())])
        )
        names = ("start", "end", "kind", "canon")
        for texts in batches:
            found = [
                pa.array([[dict(zip(names, s)) for s in find(t)] for t in some.to_pylist()], kind)
                for some in portions(texts)
            ]
            yield pa.concat_arrays(found) if found else pa.array([], kind)

    return docs.withColumn("spans", spans(F.col(f"`{text}`")))


def _space() -> Column:
    """Names share one space, other entities have one for each kind."""
    return F.when(F.col("kind").rlike("^(given|surname)-"), F.lit("name")).otherwise(F.col("kind")).alias("space")


def agreed(found: DataFrame) -> DataFrame:
    """(space, kind, canon): the distinct entities of ``found(kind, canon)``, with one kind for each.

    A name that is a given name anywhere counts as one, of the gender that its titles tell; where they
    contradict each other, or tell none, of any. Other names are surnames.
    """
    gender = {g: F.max(F.col("kind").endswith(f"-{g}")) for g in ("male", "female")}
    told = F.when(gender["male"] & ~gender["female"], "male").when(gender["female"] & ~gender["male"], "female").otherwise("any")
    script = F.min(F.get(F.split("kind", "-"), F.lit(1)))
    given = F.max(F.col("kind").startswith("given-"))
    name = F.when(given, F.concat(F.lit("given-"), script, F.lit("-"), told)).otherwise(F.concat(F.lit("surname-"), script))
    kind = F.when(F.col("space") == "name", name).otherwise(F.min("kind"))
    return found.withColumn("space", _space()).groupBy("space", "canon").agg(kind.alias("kind"))


@settled("assigned")
def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(space, canon, surrogate) for ``entities(space, kind, canon)``: distinct in a space, no real entity.

    The smallest entity keeps a surrogate that several draw; the others draw again. Nearly all are
    settled in the first round, names of small lists take some more.
    """

    @F.arrow_udf("string")
    def drawn(kinds: pa.Array, canons: pa.Array, attempts: pa.Array) -> pa.Array:
        rows = zip(kinds.to_pylist(), canons.to_pylist(), attempts.to_pylist())
        return pa.array([surrogate(key, *row) for row in rows], pa.string())

    entities = materialise(entities.select("space", "kind", "canon"), "entities")
    real = entities.select("space", F.col("canon").alias("surrogate"))
    waiting, settled, attempt = entities, None, 0
    while True:
        tried = waiting.withColumn("surrogate", drawn("kind", "canon", F.lit(attempt)))
        first = tried.groupBy("space", "surrogate").agg(F.min("canon").alias("canon"))
        free = first.join(real, ["space", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["space", "surrogate"], "left_anti")
        won = materialise(free.select("space", "canon", "surrogate"), "surrogates")
        settled = won if settled is None else settled.unionByName(won)
        waiting = materialise(waiting.join(won, ["space", "canon"], "left_anti"), "waiting")
        if waiting.isEmpty():
            return settled
        attempt += 1


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and ``n_entities``; an old column of that name goes.

    Null texts stay null; texts without entities stay as they are. Equal texts, and equal entities
    anywhere, get equal surrogates. Repeated rows and null ids are rows like any other.
    """

    @F.arrow_udf("string")
    def rewritten(texts: pa.Array, spans: pa.Array) -> pa.Array:
        done = []
        for some, own in zip(portions(texts), portions(spans)):
            out = []
            for body, found in zip(some.to_pylist(), own.to_pylist()):
                parts, at = [], 0
                for s in sorted(found or [], key=lambda s: s["start"]):
                    parts += [body[at : s["start"]], dressed(body[s["start"] : s["end"]], s["kind"], s["surrogate"])]
                    at = s["end"]
                out.append("".join([*parts, body[at:]]))
            done.append(pa.array(out, pa.string()))
        return pa.concat_arrays(done) if done else pa.array([], pa.string())

    names = [c for c in docs.columns if c != "n_entities"]
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
        F.col(f"`{text}`").alias("body"),
        F.coalesce(F.col(f"`{text}`").rlike(MAYBE), F.lit(False)).alias("maybe"),
    )
    maybe = rows.filter("maybe").withColumn("digest", F.sha2("body", 256))
    spans = detect(maybe.select("digest", "body"), "body").filter(F.size("spans") > 0)
    spans = materialise(spans.groupBy("digest").agg(F.first("spans").alias("spans")), "spans")
    flat = spans.select("digest", F.inline("spans"))
    named = flat.withColumn("space", _space())
    replaced = named.join(assign(agreed(flat.select("kind", "canon")), key), ["space", "canon"])
    by_text = replaced.groupBy("digest").agg(
        F.collect_list(F.struct("start", "end", "kind", "surrogate")).alias("found")
    )
    hit = maybe.join(by_text, "digest", "left").select(
        "row", rewritten("body", "found").alias("body"), F.coalesce(F.size("found"), F.lit(0)).alias("n_entities")
    )
    done = rows.filter("NOT maybe").select("row", "body", F.lit(0).alias("n_entities")).unionByName(hit)
    kept = [F.col("body").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in names]
    return done.select(*kept, F.col("n_entities").cast("bigint").alias("n_entities"))


#: Stands for the secret that a real run passes in.
SAMPLE_KEY = b"corpus sample key"


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, SAMPLE_KEY).select("doc_id", "text", "n_entities")


QUERIES = {"op6_surrogates": op6_surrogates}

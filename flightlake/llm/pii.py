"""Personal data replaced by keyed surrogates of the same type and format.

Found: e-mail addresses, telephone, card, social security and bank account (IBAN) numbers, IPv4 and IPv6 addresses, and the names
that follow a form of address (which gives the gender), with later bare mentions of such a name in the same
text. A title that tells no gender (Dr) takes that of another mention of the name in the text. An entity's surrogate is drawn from a keyed hash of its type and canonical form, so an entity gets the
same one everywhere (coreference), written in the format, letter case and script of each place.

Surrogates are checked over the whole corpus: one that equals another entity's surrogate, or any original,
is drawn again, round by round, until none collides (distinctness). Later draws are longer than the original, so a form of
which every value is taken (addresses of one-digit parts) does not run out. All of that works on the table of distinct
entities; texts are scanned once, and only texts that can hold an entity are joined with their
replacements, by a hash of the text.

Defined results: a null text stays null, an empty one empty, both with 0 entities; ids may be null or repeated
(equal texts get equal replacements); an empty table gives an empty result; other columns are ignored.
Texts without an entity come back unchanged. Very long texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import ipaddress
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, ship, written

#: Forms of address by the gender they tell.
ADDRESS = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "г-н", "κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа", "г-жа", "κυρία"),
    "n": ("Dr", "Prof"),
}
_GENDER = {a: g for g, names in ADDRESS.items() for a in names}
_FORMS = "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True))
_CAPITAL = r"[A-ZÀ-ÖØ-ÞΑ-ΩΆ-ΏА-ЯЁ][^\W\d_]+(?:[-'’][^\W\d_]+)?"
PATTERNS = {
    "email": re.compile(r"(?<![\w.%+-])[\w%+-]+(?:\.[\w%+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "ip": re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)"),
    "ip6": re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:.]\w|[\w:])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)"),
    "phone": re.compile(r"(?<![\w+.-])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}"
                        r"|\+\d{1,3}[ .-]?\(?\d{1,4}\)?[ ./-]?\d{5,9}|\+\d{1,3}[ .-]\d{1,2}(?:[ .-]\d{2}){3,4})(?![\w-])"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "card": re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])"),
    "name": re.compile(rf"(?<!\w)({_FORMS})(\.?\x20+)({_CAPITAL}(?:\x20{_CAPITAL}){{0,2}})"),
}
#: Earlier kinds win where two overlap.
KINDS = ("email", "iban", "ip6", "ip", "card", "ssn", "phone", "name")
#: What a text must hold for any entity; checked before anything else, in the JVM.
GATE = rf"[0-9@]|::|(?:{_FORMS})\.?\x20"
#: Letters and syllables that names are made of, by script.
SCRIPTS = {
    "latin": ("abcdefghijklmnopqrstuvwxyz", ("ba", "den", "fi", "gor", "ha", "jen", "ka", "lin", "mo", "nar", "pe", "ros", "su", "tal", "vi", "wen")),
    "greek": ("αβγδεζηθικλμνξοπρστυφχψω", ("αλ", "βα", "γε", "δη", "θε", "κα", "λι", "μα", "νι", "πε", "ρο", "στα", "τα", "φι")),
    "cyrillic": ("абвгдежзиклмнопрстуфхцчшыэюя", ("ба", "ве", "го", "да", "жа", "ка", "ли", "ма", "ни", "по", "ро", "са", "та", "фе")),
}
#: Endings by script and gender, of given and of family names.
GIVEN = {"latin": {"m": ("o", "us", "el"), "f": ("a", "ine", "elle"), "n": ("is", "y")},
         "greek": {"m": ("ος", "ης"), "f": ("α", "η"), "n": ("ι",)},
         "cyrillic": {"m": ("ан", "ор"), "f": ("ана", "ия"), "n": ("и",)}}
FAMILY = {"latin": {"m": ("son", "er", "ard"), "f": ("son", "er", "ard"), "n": ("son", "er", "ard")},
          "greek": {"m": ("ίδης",), "f": ("ίδου",), "n": ("άκη",)},
          "cyrillic": {"m": ("ов", "ин"), "f": ("ова", "ина"), "n": ("енко",)}}
#: Draws with the original's length; each further as many draws add a character.
SAME_LENGTH = 8


def script_of(word: str) -> str:
    for c in word:
        if "Ͱ" <= c <= "Ͽ":
            return "greek"
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
    return "latin"


def _lower(text: str) -> str:
    return "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _name_parts(gender: str, names: str, at: int) -> list[tuple[str, str, int, int]]:
    words = [(m[0], m.start() + at, m.end() + at) for m in re.finditer(r"\S+", names)]
    kinds = ["family"] if len(words) == 1 else ["given"] * (len(words) - 1) + ["family"]

    def shown(kind: str, word: str) -> str:  # Latin family names are the same for all genders
        script = script_of(word)
        return f"{script}:{'n' if kind == 'family' and script == 'latin' else gender}:{_lower(word)}"

    return [(k, shown(k, w), a, b) for k, (w, a, b) in zip(kinds, words)]


def _is_ip6(text: str) -> bool:
    """A valid address that holds a digit (names in code may look like the rest)."""
    try:
        return bool(ipaddress.IPv6Address(text)) and any(c.isdigit() for c in text)
    except ValueError:
        return False


def _iban_rest(iban: str) -> int:
    """The account number's checksum: 1 if it is right."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def entities(text: str) -> list[tuple[str, str, int, int]]:
    """(kind, canonical form, start, end) of all entities, in order and without overlaps."""
    found: list[tuple[str, str, int, int]] = []

    def add(kind: str, canonical: str, a: int, b: int) -> None:
        found.append((kind, canonical, a, b))

    if "@" in text:
        for m in PATTERNS["email"].finditer(text):
            add("email", _lower(m[0]), *m.span())
    if ":" in text:
        for m in PATTERNS["ip6"].finditer(text):
            if _is_ip6(m[0]):
                add("ip6", _lower(m[0]), *m.span())
    if any(c in text for c in "0123456789"):
        for m in PATTERNS["iban"].finditer(text):
            plain = m[0].replace(" ", "")
            if _iban_rest(plain) == 1:
                add("iban", plain, *m.span())
        for m in PATTERNS["ip"].finditer(text):
            add("ip", m[0], *m.span())
        for kind in ("card", "ssn", "phone"):
            for m in PATTERNS[kind].finditer(text):
                digits = re.sub(r"\D", "", m[0])
                if kind != "phone" or 7 <= len(digits) <= 15:
                    add(kind, ("+" if m[0][0] == "+" else "") + digits, *m.span())
    named: dict[str, tuple[str, str]] = {}
    parts = [p for m in PATTERNS["name"].finditer(text) for p in _name_parts(_GENDER[m[1]], m[3], m.start(3))]
    told: dict[tuple[str, str, str], str] = {}
    for kind, canonical, _, _ in parts:  # the first gender that the text tells of a name
        script, gender, word = canonical.split(":", 2)
        if gender != "n":
            told.setdefault((kind, script, word), gender)
    if parts:
        for kind, canonical, a, b in parts:
            script, gender, word = canonical.split(":", 2)
            canonical = f"{script}:{told.get((kind, script, word), 'n') if gender == 'n' else gender}:{word}"
            add(kind, canonical, a, b)
            named.setdefault(text[a:b], (kind, canonical))
    if named:
        for m in re.finditer(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(named, key=len, reverse=True))) + r")(?!\w)", text):
            add(*named[m[0]], *m.span())
    rank = {k: i for i, k in enumerate((*KINDS[:-1], "given", "family"))}
    kept: list[tuple[str, str, int, int]] = []
    for e in sorted(found, key=lambda e: (e[2], rank[e[0]], -e[3])):
        if not kept or e[2] >= kept[-1][3]:
            kept.append(e)
        elif rank[e[0]] < rank[kept[-1][0]] and e[2] == kept[-1][2]:
            kept[-1] = e
    return kept


class _Draw:
    """A keyed stream of numbers for one entity and attempt."""

    def __init__(self, key: bytes, *what: object):
        self.seed, self.pool, self.n = (key, "\x1f".join(map(str, what)).encode()), 0, 0
        self.bits = 0

    def below(self, n: int) -> int:
        if self.bits < 64:
            more = hashlib.blake2b(self.seed[1] + self.n.to_bytes(4, "big"), key=self.seed[0][:64], digest_size=64).digest()
            self.pool, self.bits, self.n = self.pool << 512 | int.from_bytes(more, "big"), self.bits + 512, self.n + 1
        self.pool, out = divmod(self.pool, n)
        self.bits -= n.bit_length()
        return out


def _letter(c: str, draw: _Draw) -> str:
    if c.isdigit():
        return str(draw.below(10))
    if c.isalpha():
        letters = SCRIPTS[script_of(c)][0]
        return letters[draw.below(len(letters))]
    return c


def _luhn(digits: str) -> int:
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10


def surrogate(key: bytes, kind: str, canonical: str, attempt: int) -> str:
    """The canonical surrogate of an entity: same length and shape (names: same script and gender); longer after ``SAME_LENGTH`` attempts."""
    draw = _Draw(key, kind, canonical, attempt)
    longer = attempt // SAME_LENGTH
    if kind in ("given", "family"):
        script, gender, _ = canonical.split(":", 2)
        endings = (GIVEN if kind == "given" else FAMILY)[script][gender]
        syllables = SCRIPTS[script][1]
        stem = "".join(syllables[draw.below(len(syllables))] for _ in range(2 + attempt // 4))
        return f"{script}:{gender}:{stem}{endings[draw.below(len(endings))]}"
    if kind == "email":
        local, _, domain = canonical.rpartition("@")
        host, _, top = domain.rpartition(".")
        return "".join(_letter(c, draw) for c in local + "a" * longer) + "@" + "".join(_letter(c, draw) for c in host) + "." + top
    if kind == "ip":
        ranges = {1: (1, 9), 2: (10, 99), 3: (100, 254)}
        return ".".join(str(a + draw.below(b - a + 1)) for a, b in ((1, 254) if longer else ranges[len(p)] for p in canonical.split(".")))
    if kind == "ip6":
        if longer:
            return ":".join(f"{1 + draw.below(65535):x}" for _ in range(8))
        return re.sub(r"[0-9a-f]+", lambda m: "".join(f"{draw.below(16) if i else 1 + draw.below(15):x}" for i in range(len(m[0]))), canonical)
    if kind == "iban":
        body = "".join(str(draw.below(10)) if c.isdigit() else chr(65 + draw.below(26)) for c in canonical[4:] + "0" * longer)
        return f"{canonical[:2]}{98 - _iban_rest(canonical[:2] + '00' + body):02d}{body}"
    plus, digits = canonical[:1] == "+", canonical.lstrip("+") + "0" * longer
    lead = max(1, len(digits) - longer - 10) if plus else 1 if kind == "card" else 0  # country code; card network
    out = digits[:lead] + "".join(str(draw.below(8) + 2 if i == lead and kind == "phone" else draw.below(10)) for i in range(lead, len(digits)))
    if kind == "card" and _luhn(canonical) == 0:
        out = out[:-1] + str((10 - _luhn(out[:-1] + "0")) % 10)
    return "+" * plus + out


def written_as(original: str, kind: str, new: str) -> str:
    """A canonical surrogate in the format and letter case of one place."""
    if kind in ("given", "family"):
        word = new.split(":", 2)[2]
        return word.upper() if original.isupper() and len(original) > 1 else word.capitalize()
    if kind == "email":
        return "".join(b.upper() if a.isupper() else b for a, b in itertools.zip_longest(original, new, fillvalue=""))
    if kind in ("ip", "ip6"):
        return new.upper() if original != original.lower() else new
    signs = iter(new.lstrip("+"))
    return "".join(next(signs) if c.isalnum() else c for c in original) + "".join(signs)


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            found = {(k, c) for k, c, _, _ in entities(text)}
            if found:
                name = hashlib.md5(text.encode()).hexdigest()
                rows += [(name, k, c) for k, c in sorted(found)]
        cols = list(zip(*rows)) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in cols], names=["text_key", "kind", "canonical"])


def _draws(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            new = [surrogate(key, kind, canonical, attempt) for kind, canonical, attempt in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], names=["kind", "canonical", "attempt", "new"])
    return run


def assign(found: DataFrame, key: bytes) -> DataFrame:
    """``kind, canonical, new`` for distinct entities, without collisions."""
    spark = found.sparkSession
    schema = "kind string, canonical string, attempt int, new string"
    drawn = written(spark, found.withColumn("attempt", F.lit(0)).mapInArrow(_draws(key), schema), "drawn")
    originals = found.select("kind", F.col("canonical").alias("new"))
    while True:  # later draws are longer, so this ends
        # among equal surrogates the one drawn first stays, so what is settled never changes
        first = drawn.groupBy("kind", "new").agg(F.min(F.struct("attempt", "canonical")).alias("first"))
        taken = originals.withColumn("taken", F.lit(True))
        checked = drawn.join(first, ["kind", "new"]).join(taken, ["kind", "new"], "left")
        loses = F.col("taken").isNotNull() | (F.col("first.canonical") != F.col("canonical"))
        checked = written(spark, checked.select("kind", "canonical", "attempt", "new", loses.alias("loses")), "checked")
        again = checked.where("loses")
        if again.isEmpty():
            return checked.select("kind", "canonical", "new")
        redrawn = again.select("kind", "canonical", (F.col("attempt") + 1).alias("attempt")).mapInArrow(_draws(key), schema)
        drawn = written(spark, checked.where("not loses").drop("loses").union(redrawn), "drawn")


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts, kinds = [], [], []
        for text, news in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            given = {(n["kind"], n["canonical"]): n["new"] for n in news or ()}
            out, at, found = [], 0, entities(text) if given else []
            for kind, canonical, a, b in found:
                out += [text[at:a], written_as(text[a:b], kind, given[kind, canonical])]
                at = b
            texts.append("".join([*out, text[at:]]) if text is not None else None)
            counts.append(len(found))
            kinds.append(",".join(sorted({f[0] for f in found})))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(kinds, pa.string())],
                                         names=["doc_id", "text", "n_entities", "kinds"])


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_entities, kinds`` with every entity replaced by its surrogate."""
    spark = docs.sparkSession
    ship(spark)
    rows = columns(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    possible = F.coalesce(F.col("text").rlike(GATE), F.lit(False))
    held = rows.where(possible)
    found = written(spark, held.select("text").mapInArrow(_detect, "text_key string, kind string, canonical string").distinct(), "found")
    news = assign(found.select("kind", "canonical").distinct(), key)
    by_text = found.join(news, ["kind", "canonical"]).groupBy("text_key").agg(
        F.collect_list(F.struct("kind", "canonical", "new")).alias("news"))  # the entities of one text
    joined = held.withColumn("text_key", F.md5(F.col("text").cast("binary"))).join(by_text, "text_key", "left")
    changed = joined.select("doc_id", "text", "news").mapInArrow(_replace, "doc_id long, text string, n_entities long, kinds string")
    same = rows.where(~possible).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("kinds"))
    return changed.union(same)

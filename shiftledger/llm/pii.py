"""Personal data: detected entities get keyed surrogates of the same type and format.

Only built-in DataFrame functions. One pattern finds e-mail addresses, IPv4 addresses, payment
card numbers, telephone numbers, social security numbers and names after titles; in a text with such
a name its parts are also replaced wherever else they stand as capitalized words. An entity is known
by its kind and its canonical form (lower case, or digits only), so that all mentions in the
corpus get one surrogate. A surrogate is drawn from a keyed SHA-256 of both:

* e-mail: local part and domain are entities of their own, so that a domain changes alike in all addresses; letters and digits change
  in place, letters within their script (``LETTERS``, others become Latin), punctuation, lengths and the top-level domain stay;
* IPv4: an address of 10.0.0.0/8; card: 13 to 19 digits whose Luhn sum is right (others are no card and stay); the first digit stays and the
  Luhn sum is right again; telephone: the
  country code and the grouping stay, and a number with ``+`` is known by its digits in any grouping; social security: an area number that is never issued;
* name: given and family name are entities of their own, without the title, so that all mentions of a family
  share one surrogate; a given name is drawn from those of the title's gender. Script and case are the mention's.
  A single name after a title counts as a family name, unless the text has it as the given name of a full name.

Not detected: names that no title introduces anywhere in the same text, parts of names in small letters, the
third and later words of a name after a title, names in scripts without capitals; telephone numbers without ``+`` other than in groups of 2-4, 3-4 and 3-4 digits
with separators; card and social security numbers with other separators; IPv6 and postal addresses, dates of birth, account numbers.

Collision checks: the distinct entities of the corpus draw together; where two draw the same
surrogate, or one that is itself an entity of the corpus, all but one draw again until all are distinct. Each
attempt draws from a larger space, so that the rounds end for any number of entities: a family name gets a syllable more, a given
name is joined to another by a hyphen, an e-mail's local part and a domain two letters more, numbers from the fourth draw on a digit more each; addresses
are drawn from 240.0.0.0 to 254.255.255.255, then from the documentation range 2001:db8::/32. The
table of entities is joined to the mentions by shuffle, never broadcast by force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.session import new_folder

KINDS = ("local", "domain", "ipv4", "card", "phone", "ssn", "given_m", "given_f", "given_n", "family")

# Titles by gender, and names by gender and script, for surrogates.
TITLES = {
    "m": ("Mr", "Herr", "Señor", "Monsieur", "Signor", "Г-н", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mademoiselle", "Signora", "Г-жа", "Κυρία"),
    "n": ("Dr", "Prof"),
}
GIVEN = {
    ("m", "latin"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo", "Max", "Noel", "Oscar", "Paul"),
    ("f", "latin"): ("Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helen", "Irma", "Julia", "Klara", "Laura", "Maria", "Nina", "Olga", "Paula"),
    ("n", "latin"): ("Alex", "Chris", "Dana", "Eden", "Jamie", "Kim", "Lee", "Marin", "Nico", "Quinn", "Robin", "Sam", "Sascha", "Toni", "Val", "Yael"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Марк", "Никита", "Олег", "Павел", "Роман", "Степан", "Юрий"),
    ("f", "cyrillic"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "Софья", "Юлия"),
    ("n", "cyrillic"): ("Саша", "Женя", "Валя", "Шура", "Слава", "Витя", "Паша", "Тоша"),
    ("m", "greek"): ("Άρης", "Βασίλης", "Γιώργος", "Δημήτρης", "Ηλίας", "Κώστας", "Μάρκος", "Νίκος", "Πέτρος", "Σπύρος"),
    ("f", "greek"): ("Άννα", "Βίκη", "Γεωργία", "Δήμητρα", "Ελένη", "Ιωάννα", "Κατερίνα", "Μαρία", "Νίκη", "Σοφία"),
    ("n", "greek"): ("Αλέξης", "Χάρις", "Κρις", "Φώτης"),
}
SYLLABLES = {
    "latin": ("bar", "del", "fen", "gor", "hal", "ker", "lin", "mar", "nor", "pel", "ros", "sen", "tal", "ver", "wel", "zan"),
    "cyrillic": ("бар", "вел", "гор", "дан", "жел", "кор", "лен", "мир", "нор", "пол", "рас", "сол", "тар", "ува", "фед", "чер"),
    "greek": ("βαλ", "γερ", "δελ", "ζαν", "θορ", "καρ", "λιν", "μαρ", "νικ", "παλ", "ροσ", "σολ", "ταρ", "φεν", "χαλ", "ψαρ"),
}
# Letters for addresses by script: a class of Java's patterns, the first letter and how many follow it in Unicode without a gap.
LETTERS = {
    r"\p{IsCyrillic}": ("а", 32), r"\p{IsGreek}": ("α", 25), r"\p{IsHebrew}": ("א", 27), r"\p{IsArabic}": ("ب", 18),
    r"\p{IsArmenian}": ("ա", 38), r"\p{IsGeorgian}": ("ა", 33), r"\p{IsDevanagari}": ("क", 37), r"\p{IsThai}": ("ก", 46),
    r"\p{IsHiragana}": ("か", 30), r"\p{IsKatakana}": ("カ", 30), r"\p{IsHan}": ("一", 200), r"\p{IsHangul}": ("가", 200),
}
_TITLE = "|".join(sorted((t for held in TITLES.values() for t in held), key=lambda t: (-len(t), t)))
_EDGE, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_WORD = r"\p{Lu}\p{L}*+(?:['’-](?![sS](?!\p{L}))\p{L}++)*+"  # a capitalized word without the 's of a genitive
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}.-]*[\p{L}\p{N}]\.\p{L}{2,}",
    "ipv4": r"(?<![\p{L}\p{N}.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\.?[\p{L}\p{N}])",
    "card": _EDGE + r"(?:\d{13,19}|\d{4}(?:[\x20-]\d{4}){3}|\d{4}[\x20-]\d{6}[\x20-]\d{5})" + _END,
    "ssn": _EDGE + r"\d{3}-\d{2}-\d{4}" + _END,
    "phone": r"(?<![\p{L}\p{N}+.])(?:\+\(?\d(?:[\x20.()/-]{0,3}\d){6,14}" + _END + r"|(?:\+\d{1,3}[\x20.-]?)?(?:\(\d{2,4}\)[\x20.-]?|\d{2,4}[\x20.-])\d{3,4}[\x20.-]\d{3,4}" + _END + ")",
    "name": _EDGE + rf"(?:(?:{_TITLE})\.?\x20)+{_WORD}(?:\x20{_WORD})?",
}
TITLES_OF = rf"^((?:(?:{_TITLE})\.?\x20)+(?=\p{{Lu}}))"  # of a name's mention
WORD = _EDGE + _WORD  # what may be part of a name
TOP = r"\.[^.]*$"  # of a domain
CODE = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"  # E.164 country codes
PARTS = "array<struct<text:string,surface:string,role:string,counts:boolean>>"
# No kind starts within a word, and the first character tells which kinds may start: most places are passed at one look.
PATTERN = (
    rf"{_EDGE}(?:{PATTERNS['email']}|(?=[+(\d])(?:{'|'.join(PATTERNS[k] for k in ('ipv4', 'card', 'ssn', 'phone'))})"
    rf"|(?=\p{{Lu}}){PATTERNS['name']})"
)
_ZERO, _MARK = "\x00\x01", "\x00\x02"  # stand for a null character of the text and for the edges of what was found


def _is_name(surface: Column) -> Column:
    """Whether something found is a name: it alone starts with a letter and is no address."""
    return ~surface.contains("@") & ~F.substring(surface, 1, 1).isin(list("+(0123456789"))


def _kind(surface: Column) -> Column:
    whole = lambda kind: surface.rlike(f"^(?:{PATTERNS[kind]})$")
    return (
        F.when(surface.contains("@"), "email").when(_is_name(surface), "name").when(whole("ipv4"), "ipv4").when(whole("card"), "card")
        .when(whole("ssn"), "ssn").otherwise("phone")
    )


def _canonical(kind: Column, surface: Column) -> Column:
    digits = F.regexp_replace(surface, r"\D", "")
    code = F.regexp_extract(digits, CODE, 1)
    return (
        F.when(kind.isin("local", "domain", "family") | kind.startswith("given_"), F.lower(surface)).when(kind == "ipv4", surface)
        .when(surface.startswith("+"), F.concat(F.lit("+"), code, F.lit(" "), F.substring(digits, F.length(code) + 1, F.length(digits))))
        .otherwise(digits)
    )


def _draw(key: str, *parts: Column) -> Column:
    """64 hexadecimal digits from a keyed hash."""
    return F.sha2(F.concat_ws("\x00", F.lit(key), *[p.cast("string") for p in parts], F.lit(key)).cast("binary"), 256)


def _byte(drawn: Column, at: Column | int) -> Column:
    place = (F.lit(at) if isinstance(at, int) else at) % 31
    return F.conv(F.substring(drawn, place * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _changed(text: Column, drawn: Column) -> Column:
    """Letters and digits of a lower-case text changed in place, letters within their script; other characters stay."""
    def change(character: Column, i: Column) -> Column:
        byte = _byte(drawn, i) + i
        letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), byte % 26 + 1, F.lit(1))
        other = letter
        for script, (first, count) in LETTERS.items():
            row = "".join(chr(ord(first) + place) for place in range(count))
            other = F.when(character.rlike(script), F.substring(F.lit(row), byte % count + 1, F.lit(1))).otherwise(other)
        return (
            F.when(character.rlike(r"\d"), F.substring(F.lit("0123456789"), byte % 10 + 1, F.lit(1)))
            .when(character.rlike("[a-z]"), letter).when(character.rlike(r"\p{L}"), other).otherwise(character)
        )
    return F.array_join(F.transform(F.split(text, ""), change), "")


def _lengthened(text: Column, key: str, drawn: Column, canonical: Column, attempt: Column) -> Column:
    """A changed text with two letters more at each attempt, in the script of its first letter."""
    model = F.regexp_extract(text, r"\p{L}", 0)
    more = F.repeat(F.when(model == "", "a").otherwise(model), attempt * 2)
    return F.concat(_changed(text, drawn), _changed(more, _draw(key, F.lit("letters"), canonical, attempt)))


def _digits(drawn: Column, count: Column, first: Column) -> Column:
    """``first`` and then drawn digits, ``count`` digits in all."""
    tail = F.transform(F.sequence(F.lit(1), F.greatest(count - F.length(first), F.lit(1))), lambda i: (_byte(drawn, i) % 10).cast("string"))
    return F.substring(F.concat(first, F.array_join(tail, "")), F.lit(1), count)


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """The Luhn sum; every other digit from the right counts twice, from the place ``doubled`` on."""
    def weight(d: Column, i: Column) -> Column:
        twice = d.cast("int") * F.when(i % 2 == doubled, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.transform(F.reverse(F.split(digits, "")), weight), F.lit(0), lambda a, b: a + b)


def _luhn(digits: Column) -> Column:
    """Digits with the last one set so that the Luhn sum is a multiple of ten."""
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    return F.concat(body, ((10 - _luhn_sum(body, 0) % 10) % 10).cast("string"))


def _choice(values: tuple[str, ...], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at % len(values))


def _choices(values: tuple[str, ...], drawn: Column, first: Column, last: Column, between: str) -> Column:
    """Values drawn by the bytes from ``first`` to ``last``, joined."""
    return F.array_join(F.transform(F.sequence(first, last), lambda i: _choice(values, _byte(drawn, i))), between)


def _name(kind: Column, canonical: Column, drawn: Column, attempt: Column) -> Column:
    """A given or a family name in small letters. Each attempt has a syllable or a given name more."""
    script = F.when(canonical.rlike(r"\p{IsCyrillic}"), "cyrillic").when(canonical.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    name = F.lit(None).cast("string")
    for (g, s), names in GIVEN.items():
        name = F.when((kind == f"given_{g}") & (script == s), _choices(names, drawn, F.lit(0), attempt, "-")).otherwise(name)
    for s, syllables in SYLLABLES.items():
        name = F.when((kind == "family") & (script == s), _choices(syllables, drawn, F.lit(1), attempt + 4, "")).otherwise(name)
    return F.lower(name)


def surrogate(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """The canonical form of the surrogate at an attempt; later attempts draw from a larger space."""
    drawn = _draw(key, kind, canonical, attempt)
    top = F.regexp_extract(canonical, TOP, 0)
    host = F.substring(canonical, F.lit(1), F.length(canonical) - F.length(top))
    domain = F.concat(_lengthened(host, key, drawn, canonical, attempt), top)
    octets = [_byte(drawn, i).cast("string") for i in range(3)]
    ipv4 = (
        F.when(attempt == 0, F.concat_ws(".", F.lit("10"), *octets))
        .when(attempt < 4, F.concat_ws(".", (240 + _byte(drawn, 3) % 15).cast("string"), *octets))
        .otherwise(F.concat(F.lit("2001:db8"), *[F.concat(F.lit(":"), F.substring(drawn, 4 * i + 1, 4)) for i in range(6)]))
    )
    more = F.greatest(attempt - 2, F.lit(0))
    card = _luhn(_digits(drawn, F.length(canonical) + more, F.substring(canonical, 1, 1)))
    code = F.when(canonical.startswith("+"), F.concat(F.split(canonical, " ", 2)[0], F.lit(" "))).otherwise("")
    number = F.regexp_replace(canonical, r"^\+\d+\x20", "")
    phone = F.concat(code, _digits(drawn, F.length(number) + more, (2 + _byte(drawn, 0) % 8).cast("string")))
    ssn = _digits(drawn, 9 + more, F.lit("9"))
    return (
        F.when(kind == "local", _lengthened(canonical, key, drawn, canonical, attempt)).when(kind == "domain", domain).when(kind == "ipv4", ipv4).when(kind == "card", card)
        .when(kind == "phone", phone).when(kind == "ssn", ssn).otherwise(_name(kind, canonical, drawn, attempt))
    )


def rendered(kind: Column, surface: Column, found: Column) -> Column:
    """The surrogate in the form of the mention: its separators, its case.

    Letters added to an address stand in small letters at the end of its local part or before the top-level domain, added digits at the end.
    """
    own = F.split(surface, "")
    at = F.length(surface) - F.when(kind == "domain", F.length(F.regexp_extract(surface, TOP, 0))).otherwise(0)
    added = F.length(found) - F.length(surface)

    def case(c: Column, i: Column) -> Column:
        model = F.when(i < at, F.get(own, i)).when(i >= at + added, F.get(own, i - added))
        return F.when(model != F.lower(model), F.upper(c)).otherwise(c)

    cased = F.array_join(F.transform(F.split(found, ""), case), "")
    digits = F.split(F.regexp_replace(found, r"\D", ""), "")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def put(held: Column, c: Column) -> Column:
        digit = c.rlike(r"\d")
        return F.struct(
            (held["at"] + digit.cast("int")).alias("at"),
            F.concat(held["text"], F.when(digit, F.get(digits, held["at"])).otherwise(c)).alias("text"),
        )

    numbered = F.aggregate(
        F.split(surface, ""), start, put,
        lambda held: F.concat(held["text"], F.array_join(F.slice(digits, held["at"] + 1, F.size(digits)), "")),
    )
    loud = (surface == F.upper(surface)) & (F.length(surface) > 2)
    named = F.when(loud, F.upper(found)).otherwise(F.array_join(F.transform(F.split(found, "-"), F.initcap), "-"))
    named_kind = (kind == "family") | kind.startswith("given_")
    return F.when(kind.isin("local", "domain"), cased).when(kind == "ipv4", found).when(named_kind, named).otherwise(numbered)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _part(text: Column, surface: Column | None = None, role: Column | None = None, counts: bool = True) -> Column:
    """Some text and the mention after it; ``role`` is the mention's kind, or what may be known from other mentions."""
    none = F.lit(None).cast("string")
    return F.struct(
        text.alias("text"), (none if surface is None else surface).alias("surface"), (none if role is None else role).alias("role"),
        F.lit(counts).alias("counts"),
    )


def _mentioned(surface: Column) -> Column:
    """The parts of one mention: a name after titles in one or two words, an e-mail's local part and domain, other kinds whole.

    Digits like a card's with a wrong Luhn sum are plain text.
    """
    titles = F.regexp_extract(surface, TITLES_OF, 1)
    words = F.split(F.substring(surface, F.length(titles) + 1, F.length(surface)), " ")
    gender = F.lit("n")
    for g in ("f", "m"):
        gender = F.when(surface.rlike(rf"(?:^|\x20)(?:{'|'.join(TITLES[g])})\.?\x20(?=.*\p{{Lu}})"), g).otherwise(gender)
    full = F.array(_part(titles, words[0], F.concat(F.lit("given_"), gender)), _part(F.lit(" "), words[1], F.lit("family"), False))
    address = F.split(surface, "@", 2)
    email = F.array(_part(F.lit(""), address[0], F.lit("local")), _part(F.lit("@"), address[1], F.lit("domain"), False))
    numbered = _once(_kind(surface), lambda kind: F.when(
        (kind == "card") & (_luhn_sum(F.regexp_replace(surface, r"\D", ""), 1) % 10 != 0), F.array(_part(surface))
    ).otherwise(F.array(_part(F.lit(""), surface, kind))))
    return (
        F.when(surface.contains("@"), email).when(~_is_name(surface), numbered)
        .when(F.size(words) == 2, full).otherwise(F.array(_part(titles, words[0], F.lit("only"))))
    )


def _cut(text: Column, pattern: str) -> Column:
    """The text in turn outside and inside of the pattern's matches, starting outside, by one pass of the pattern.

    The null characters of the text are held apart from the marks meanwhile.
    """
    marked = F.regexp_replace(F.replace(text, F.lit("\x00"), F.lit(_ZERO)), pattern, f"{_MARK}$0{_MARK}")
    return F.transform(F.split(marked, _MARK, -1), lambda piece: F.replace(piece, F.lit(_ZERO), F.lit("\x00")))


def _parts(text: Column) -> Column:
    """The whole text cut into parts. Capitalized words are mentions of role ``word`` if the text has a name after a title."""
    def outside(piece: Column) -> Column:
        return F.flatten(F.transform(_cut(piece, WORD), lambda x, i: F.array(
            F.when(i % 2 == 0, _part(x)).otherwise(_part(F.lit(""), x, F.lit("word")))
        )))

    def whole(pieces: Column) -> Column:
        named = F.exists(F.transform(pieces, lambda x, i: (i % 2 == 1) & _is_name(x)), lambda x: x)
        return _once(named, lambda named: F.flatten(F.transform(pieces, lambda x, i: (
            F.when(i % 2 == 1, _mentioned(x)).when(named, outside(x)).otherwise(F.array(_part(x)))
        ))))

    return _once(_cut(text, PATTERN), whole)


def _resolved(mentions: DataFrame) -> DataFrame:
    """Mentions with their kind; single names and words take it from the full names of their text, other words are dropped."""
    kept = ["pii_row", "place", "surface", "counts"]
    word = F.lower("surface").alias("word")
    parts = mentions.filter(F.col("role").isin("given_m", "given_f", "given_n", "family", "only"))
    rank = F.when(F.col("role") == "family", 0).when(F.col("role") == "only", 2).otherwise(1)
    known = parts.groupBy("pii_row", word).agg(F.min(F.struct(rank.alias("rank"), "place", "role"))["role"].alias("role"))
    known = known.select("pii_row", "word", F.when(F.col("role") == "only", "family").otherwise(F.col("role")).alias("kind"))
    open_ = F.col("role").isin("only", "word")
    told = mentions.filter(open_).select(*kept, word).join(known, ["pii_row", "word"]).select(*kept, "kind")
    return mentions.filter(~open_).select(*kept, F.col("role").alias("kind")).unionByName(told)


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate) with distinct surrogates, none of them an entity of the same kind.

    Of the entities that draw one surrogate the one with the fewest attempts, then the smallest
    form, keeps it. Each round is written to the shared folder; one number per round reaches the driver.
    """
    spark = entities.sparkSession

    def kept(frame: DataFrame) -> DataFrame:
        folder = new_folder(spark, "surrogates")
        frame.write.parquet(folder)
        return spark.read.parquet(folder)

    drawn = kept(
        entities.select("kind", "canonical").distinct().withColumn("attempt", F.lit(0))
        .withColumn("surrogate", surrogate(key, F.col("kind"), F.col("canonical"), F.col("attempt")))
    )
    taken = drawn.select("kind", F.col("canonical").alias("surrogate"), F.lit(True).alias("is_entity"))
    while True:
        order = Window.partitionBy("kind", "surrogate").orderBy("attempt", "canonical")
        checked = drawn.withColumn("turn", F.row_number().over(order)).join(taken, ["kind", "surrogate"], "left")
        again = (F.col("turn") > 1) | F.col("is_entity").isNotNull()
        checked = kept(checked.select("kind", "canonical", "attempt", "surrogate", again.alias("again")))
        if not checked.filter("again").limit(1).count():
            return checked.select("kind", "canonical", "surrogate")
        attempt = F.col("attempt") + F.col("again").cast("int")
        drawn = checked.select(
            "kind", "canonical", attempt.alias("attempt"),
            F.when(F.col("again"), surrogate(key, F.col("kind"), F.col("canonical"), attempt)).otherwise(F.col("surrogate")).alias("surrogate"),
        )


def with_surrogates(docs: DataFrame, key: str, text: str = "text", name: str = "n_entities") -> DataFrame:
    """The documents with surrogates in their texts, and the number of entities replaced (``name``).

    The same key gives the same surrogates for the same corpus. Null texts stay null; texts without entities stay as they
    are; repeated rows are treated alike; an empty table gives no rows. All other columns are kept; where one of them has the
    name of the count, the count's name gets underscores until it is free.
    """
    spark = docs.sparkSession
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    folder = new_folder(spark, "entities")
    held = docs[text].cast("string")
    others = [F.lit(None).cast(docs.schema[c].dataType).alias(c) if c == text else docs[c] for c in docs.columns]
    docs.select(
        F.monotonically_increasing_id().alias("pii_row"), F.struct(*others).alias("pii_held"), _parts(held).alias("pii_parts"),
    ).write.parquet(folder)
    found = spark.read.parquet(folder)
    mentions = found.select("pii_row", F.posexplode("pii_parts").alias("place", "part")).select("pii_row", "place", "part.surface", "part.role", "part.counts")
    mentions = _resolved(mentions.filter(F.col("surface").isNotNull()))
    mentions = mentions.withColumn("canonical", _canonical(F.col("kind"), F.col("surface")))
    table = distinct_surrogates(mentions, key)
    new = rendered(F.col("kind"), F.col("surface"), F.col("surrogate")).alias("new")
    replaced = (
        mentions.join(table, ["kind", "canonical"]).select("pii_row", "counts", F.struct("place", new).alias("one"))
        .groupBy("pii_row").agg(F.sort_array(F.collect_list("one")).alias("new"), F.count_if("counts").alias("n"))  # as many as the text has entities
    )
    # parts up to each replaced one, then the rest: every part is looked at once
    has = F.exists("pii_parts", lambda x: x["surface"].isNotNull())
    plain = lambda parts: F.array_join(F.transform(parts, lambda x: F.concat(x["text"], F.coalesce(x["surface"], F.lit("")))), "")

    def upto(one: Column, i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(F.col("new"), i - 1)["place"] + 1)
        return F.concat(plain(F.slice("pii_parts", start + 1, one["place"] - start)), F.get(F.col("pii_parts"), one["place"])["text"], one["new"])

    after = F.element_at("new", -1)["place"] + 1
    rest = plain(F.slice("pii_parts", after + 1, F.size("pii_parts")))
    joined = F.concat(F.array_join(F.transform("new", upto), ""), rest)
    out = lambda value, count, frame: frame.select(
        *[(value if c == text else F.col("pii_held")[c]).alias(c) for c in docs.columns], count.cast("long").alias(name),
    )
    some = found.filter(has).join(replaced, "pii_row")
    return out(joined, F.col("n"), some).unionByName(out(plain(F.col("pii_parts")), F.lit(0), found.filter(~F.coalesce(has, F.lit(False)))))

"""Surrogates for personal data, in DataFrame operations only.

Patterns find e-mail addresses, phone numbers, payment cards, account numbers,
network addresses, national ids, secrets and names after a form of address. Every
entity (type and normal form) gets one keyed surrogate for the whole corpus, so
mentions of one entity stay mentions of one: a keyed hash of type, normal form and
attempt drives a replacement of the same type, character by character - digits stay
digits, letters stay letters of their script, hexadecimal stays hexadecimal, cards
keep a valid check digit - and names become names of the same gender and script.
Mentions keep their own separators and case; IPv6 addresses are written out in full.

A family name has one surrogate, which its full names share. In a text that has a
name after a form of address, the name's capitalised words are replaced wherever
else they stand in that text: full names as a whole, family and given names alone.

Attempts start at 0. An entity whose surrogate another entity also has, or that is
itself an entity of the corpus, tries the next attempt until none collides, so
distinct entities stay distinct and no surrogate is someone's real data. Attempts
travel with the entities; texts are rewritten only where they have any.

Defined results: null texts stay null, empty ones empty; rows stay as they are, also
repeated ones; a null id is a value like any other; an empty table gives an empty
table; further columns pass through unread, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

# Forms of address by gender, names by script and gender, syllables.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir", "г-н", "господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа")
OTHER_TITLES = ("Dr", "Prof")
NAMES = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karim Lukas Marco Nils Oscar Paul",
    ("latin", "f"): "Alma Berta Clara Diana Elena Flora Greta Helga Irina Julia Karin Laura Maria Nadia Olga Paula",
    ("latin", "x"): "Alex Bo Chris Dana Eli Francis Gabi Jo Kim Lou Max Nico Robin Sam Toni Vic",
    ("cyrillic", "m"): "Антон Борис Вадим Глеб Денис Егор Захар Игорь Кирилл Леонид Максим Никита Олег Павел Роман Тимур",
    ("cyrillic", "f"): "Анна Белла Вера Галина Дарья Елена Жанна Зоя Инна Кира Лидия Мария Нина Ольга Полина Раиса",
    ("cyrillic", "x"): "Женя Саша Валя Слава Шура Тоня Паша Ася Рома Стася Тася Вася Даня Гоша Сима Юля",
}
SYLLABLES = {"latin": "ba den fo gar hel ki lam mer nor pas rin sol tav ulm wes zan",
             "cyrillic": "ба ден фо гар хел ки лам мер нор пас рин сол тав ум вес зан"}
ALPHABET = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщыэюя",
            "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_TITLES = "|".join((*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES))
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_HEX = "[0-9a-fA-F]{1,4}"
_W = r"(?<![\p{L}\p{N}_])"
_E = r"(?![\p{L}\p{N}_])"

#: Types in the order in which they are tried at a place in a text.
PATTERNS: dict[str, str] = {
    "email": r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "secret": _W + r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|"
                   r"sk-[A-Za-z0-9_-]{20,})" + _E,
    "iban": _W + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _E,
    "card": _W + r"(?:[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|"
                 r"[0-9]{4}[ -][0-9]{4}[ -][0-9]{5}|[0-9]{6}[ -][0-9]{13}|[0-9]{13,19})" + _E,
    "ssn": _W + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _E,
    "phone": r"(?<![\p{L}\p{N}_+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|"
             r"[0-9]{2,4}[ .-][0-9]{3,4}[ .-][0-9]{4})" + _E + r"|(?<![\p{L}\p{N}_+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}" + _E,
    "ipv6": r"(?=[0-9a-fA-F]{0,4}:)(?<![\p{L}\p{N}_:.])(?=[0-9a-fA-F:]*[0-9])"
            rf"(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{6}}{_V4}|"
            rf"(?:{_HEX}(?::{_HEX}){{0,5}})?::(?:(?:{_HEX}:){{0,4}}{_V4}|{_HEX}(?::{_HEX}){{0,5}})?)(?![\p{{L}}\p{{N}}_:])",
    "ip": _W + rf"{_OCTET}(?:\.{_OCTET}){{3}}" + _E,
    "name": _W + rf"(?:{_TITLES})\.? \p{{Lu}}\p{{L}}+(?:-\p{{Lu}}\p{{L}}+)?(?: \p{{Lu}}\p{{L}}+(?:-\p{{Lu}}\p{{L}}+)?)?" + _E,
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Every match contains this; texts without it are passed over by a cheap scan.
HINT = rf"[@0-9]|[0-9a-fA-F]{{32}}|AKIA|gh[pousr]_|sk-|(?:{_TITLES})"
DIGITS = ("card", "ssn", "phone")
_WORD = r"\p{Lu}\p{L}+(?:-\p{Lu}\p{L}+)?"
#: Capitalised words in a row, among which names are found again.
RUN = _W + rf"{_WORD}(?: {_WORD})*" + _E


def _type_of(mention: Column) -> Column:
    out = F.lit("name")
    for name in reversed([n for n in PATTERNS if n != "name"]):
        out = F.when(mention.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(out)
    return out


def _bare_name(mention: Column) -> Column:
    return F.regexp_replace(mention, rf"^(?:{_TITLES})\.? ", "")


def _gender(mention: Column) -> Column:
    def after(titles):
        return mention.rlike(rf"^(?:{'|'.join(titles)})\.? ")
    return F.when(after(MALE_TITLES), "m").when(after(FEMALE_TITLES), "f").otherwise("x")


def _full_ipv6(mention: Column) -> Column:
    """Eight groups in lower case without leading zeros."""
    def groups(part: Column) -> Column:
        return F.filter(F.split(part, ":"), lambda g: g != "")

    def hexed(m: Column) -> Column:  # a dotted tail as two groups
        o = F.transform(F.split(F.regexp_extract(m, r"([0-9.]+)$", 1), r"\."), lambda x: x.cast("int"))
        return F.when(F.instr(m, ".") > 0, F.concat(
            F.regexp_replace(m, r"[0-9]+\.[0-9.]+$", ""),
            let(o, lambda a: F.concat_ws(":", *[F.lower(F.hex(F.get(a, i) * 256 + F.get(a, i + 1))) for i in (0, 2)])),
        )).otherwise(m)

    def full(m: Column) -> Column:
        head, tail = groups(F.substring_index(m, "::", 1)), groups(F.substring_index(m, "::", -1))
        zeros = F.greatest(F.lit(0), 8 - F.size(head) - F.size(tail))
        return F.when(F.instr(m, "::") > 0, F.concat(head, F.array_repeat(F.lit("0"), zeros), tail)).otherwise(groups(m))
    return F.array_join(F.transform(let(hexed(F.lower(mention)), full),
                                    lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")


def _normal(kind: Column, mention: Column) -> Column:
    """What mentions of one entity have in common."""
    return (F.when(kind.isin(*DIGITS), F.regexp_replace(mention, "[^0-9]", ""))
            .when(kind == "name", F.lower(_bare_name(mention)))
            .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
            .when(kind == "ipv6", _full_ipv6(mention))
            .when(kind.isin("email"), F.lower(mention)).otherwise(mention))


def _byte(hashed: Column, i) -> Column:
    """Byte i (modulo 32) of a hexadecimal SHA-256."""
    return F.conv(F.substring(hashed, (i % 32) * 2 + 1, F.lit(2)) if isinstance(i, Column)
                  else F.substring(hashed, (i % 32) * 2 + 1, 2), 16, 10).cast("int")


def _pick(chars: str, at: Column) -> Column:
    return F.substring(F.lit(chars), at % len(chars) + 1, F.lit(1))


def _hash(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts).cast("binary"), 256)


def _substituted(text: Column, hashed: Column, hexadecimal: bool = False) -> Column:
    """Each digit and letter of ``text`` replaced by one of its kind."""
    def one(c: Column, i: Column) -> Column:
        # Past 32 characters the position moves the byte as well.
        b = _byte(hashed, i) + F.floor(i / 32).cast("int") * 7
        if hexadecimal:
            return (F.when(c.rlike("[0-9a-f]"), _pick("0123456789abcdef", b))
                    .when(c.rlike("[0-9A-F]"), _pick("0123456789ABCDEF", b)).otherwise(c))
        low = (F.when(F.lower(c).rlike(r"\p{IsCyrillic}"), _pick(ALPHABET["cyrillic"], b))
               .when(F.lower(c).rlike(r"\p{IsGreek}"), _pick(ALPHABET["greek"], b))
               .otherwise(_pick(ALPHABET["latin"], b)))
        return (F.when(c.rlike("[0-9]"), _pick("0123456789", b))
                .when(c.rlike(r"\p{Lu}"), F.upper(low)).when(c.rlike(r"\p{L}"), low).otherwise(c))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn_sum(digits: Column, shift: int) -> Column:
    """Luhn sum of a digit string; shift 1 if a check digit is still to come."""
    n = F.char_length(digits)
    return F.aggregate(
        F.transform(F.split(digits, ""), lambda c, i: F.when(
            (n - 1 - i + shift) % 2 == 1,
            F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
            .otherwise(c.cast("int"))),
        F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0)))


def _card(normal: Column, hashed: Column) -> Column:
    def checked(drawn: Column) -> Column:
        head = F.substring(drawn, F.lit(1), F.char_length(drawn) - 1)
        digit = (F.lit(10) - _luhn_sum(head, 1) % 10) % 10
        return F.when(_luhn_sum(normal, 0) % 10 == 0, F.concat(head, digit.cast("string"))).otherwise(drawn)
    return let(_substituted(normal, hashed), checked)


def _title(s: Column) -> Column:
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, F.lit(2), F.char_length(s)))


def _name(normal: Column, gender: Column, attempt: Column, key: str, family_name: Column) -> Column:
    """A family name of syllables in the name's script, or, for a full name, a given name
    by gender before ``family_name``; each attempt may be longer by a syllable."""
    cyrillic = normal.rlike(r"\p{IsCyrillic}")
    hashed = _hash(key, F.lit("name"), gender, normal, attempt.cast("string"))

    def made(h: Column) -> Column:
        def listed(words: str, at: Column) -> Column:
            parts = words.split(" ")
            return F.element_at(F.array(*map(F.lit, parts)), at % len(parts) + 1)

        def syllables(script: str, n: Column) -> Column:
            return _title(F.array_join(F.transform(
                F.sequence(F.lit(1), F.least(n, F.lit(30))), lambda i: listed(SYLLABLES[script], _byte(h, i))), ""))

        def given(script: str) -> Column:
            first = (F.when(gender == "m", listed(NAMES[script, "m"], _byte(h, 0)))
                     .when(gender == "f", listed(NAMES[script, "f"], _byte(h, 0)))
                     .otherwise(listed(NAMES[script, "x"], _byte(h, 0))))
            # A family may have more given names than the lists.
            return F.when(attempt == 0, first).otherwise(F.concat_ws("-", first, syllables(script, attempt)))
        both = F.concat_ws(" ", F.when(cyrillic, given("cyrillic")).otherwise(given("latin")), family_name)
        only = F.when(cyrillic, syllables("cyrillic", F.lit(3) + attempt)).otherwise(
            syllables("latin", F.lit(3) + attempt))
        return F.when(F.instr(normal, " ") > 0, both).otherwise(only)
    return let(hashed, made)


def _surrogate(kind: Column, normal: Column, gender: Column, attempt: Column, key: str, family: Column) -> Column:
    """The normal form of an entity's surrogate."""
    hashed = _hash(key, kind, normal, attempt.cast("string"))

    def made(h: Column) -> Column:
        domain = F.regexp_extract(normal, "@(.*)$", 1)
        host = F.regexp_extract(domain, r"^(.*)(\.[^.]*)$", 1)
        # One domain stays one domain: its letters are keyed by the domain alone.
        # Few mailboxes have few replacements of their length: each attempt is a letter longer.
        more = F.when(attempt > 0, F.array_join(F.transform(
            F.sequence(F.lit(1), attempt), lambda i: _pick(ALPHABET["latin"], _byte(h, 31 - i % 32))), "")).otherwise("")
        email = F.concat(
            _substituted(F.regexp_extract(normal, "^(.*)@", 1), h), more, F.lit("@"),
            let(_hash(key, F.lit("domain"), domain), lambda d: _substituted(host, d)),
            F.regexp_extract(domain, r"(\.[^.]*)$", 1))
        ip = F.concat_ws(".", (_byte(h, 0) % 223 + 1).cast("string"),
                         *[_byte(h, i).cast("string") for i in (1, 2, 3)])
        ipv6 = F.concat_ws(":", F.concat(F.lit("2"), F.substring(h, 2, 3)), *[
            F.regexp_replace(F.substring(h, 4 * i + 1, 4), "^0+(?=.)", "") for i in range(1, 8)])
        iban = F.concat(F.substring(normal, 1, 2),
                        _substituted(F.substring(normal, F.lit(3), F.char_length(normal)), h))
        secret = F.when(normal.rlike("^[0-9a-fA-F]+$"), _substituted(normal, h, True)).otherwise(F.concat(
            F.regexp_extract(normal, "^(AKIA|gh[pousr]_|sk-)", 1),
            _substituted(F.regexp_replace(normal, "^(AKIA|gh[pousr]_|sk-)", ""), h)))
        return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ipv6", ipv6).when(kind == "iban", iban)
                .when(kind == "secret", secret).when(kind == "card", _card(normal, h))
                .when(kind == "name", _name(normal, gender, attempt, key, family))
                .otherwise(_substituted(normal, h)))
    return let(hashed, made)


def _formatted(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the form of the mention: separators, case, form of address."""
    def spread(keep: str) -> Column:
        # Characters of the surrogate in the places of the mention's own.
        return F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike(keep), F.substring(
            surrogate, F.char_length(F.regexp_replace(F.substring(mention, F.lit(1), i), f"[^{keep[1:]}", "")) + 1,
            F.lit(1))).otherwise(c)), "")
    # The surrogate may be longer than the mention.
    cased = F.array_join(F.transform(F.split(surrogate, ""), lambda c, i: F.when(
        F.substring(mention, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")
    address = F.regexp_extract(mention, rf"^((?:{_TITLES})\.? )", 1)
    loud = (_bare_name(mention) == F.upper(_bare_name(mention)))
    return (F.when(kind.isin(*DIGITS), spread("[0-9]")).when(kind == "iban", spread("[A-Z0-9]"))
            .when(kind == "email", cased)
            .when((kind == "ipv6") & (mention != F.lower(mention)), F.upper(surrogate))
            .when(kind == "name", F.concat(address, F.when(loud, F.upper(surrogate)).otherwise(surrogate)))
            .otherwise(surrogate))


def _mentions(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(ANY), 0)
    return F.when(text.rlike(HINT), found).otherwise(F.array().cast("array<string>"))


def _family(normal: Column) -> Column:
    return F.substring_index(normal, " ", -1)


def entities(docs: DataFrame, key: str, text_col: str = "text", rounds: int = 64) -> DataFrame:
    """``kind, normal, gender, surrogate`` of every entity, free of collisions."""
    found = docs.select(F.explode(F.array_distinct(_mentions(F.col(text_col)))).alias("m")).distinct()
    found = found.select(_type_of(F.col("m")).alias("kind"), "m")
    # Stored, as it is read twice: texts are searched for mentions once here.
    found = stored(found.select("kind", _normal(F.col("kind"), F.col("m")).alias("normal"),
                                F.when(F.col("kind") == "name", _gender(F.col("m"))).alias("gender")), "pii-mentions")
    # A name's gender is what its mentions say, if any does.
    # A full name brings its family name along.
    full = found.where((F.col("kind") == "name") & (F.instr("normal", " ") > 0))
    found = found.union(full.select("kind", _family(F.col("normal")), "gender"))
    real = stored(found.groupBy("kind", "normal").agg(F.min(F.when(F.col("gender") != "x", F.col("gender")))
                                                      .alias("gender")), "pii-entities")

    def drawn(rows: DataFrame) -> DataFrame:
        return rows.select("kind", "normal", "gender", "family", "attempt", _surrogate(
            F.col("kind"), F.col("normal"), F.coalesce("gender", F.lit("x")), F.col("attempt"), key,
            F.col("family")).alias("surrogate"))

    taken = real.select(F.col("kind").alias("_k"), F.lower("normal").alias("_n"))

    def settled(rows: DataFrame) -> DataFrame:
        now = stored(drawn(rows.withColumn("attempt", F.lit(0))), "pii-surrogates")
        for _ in range(rounds):
            same = F.lower("surrogate").alias("_s")
            first = now.groupBy("kind", same).agg(F.min("normal").alias("_first"), F.count("*").alias("_c"))
            clash = first.where("_c > 1").select(F.col("kind").alias("_k"), "_s", "_first")
            twice = now.join(clash, (F.col("kind") == F.col("_k")) & (F.lower("surrogate") == F.col("_s"))).where(
                "normal <> _first")
            real_one = now.join(taken, (F.col("kind") == F.col("_k")) & (F.lower("surrogate") == F.col("_n")), "left_semi")
            bad = stored(twice.select("kind", "normal").union(real_one.select("kind", "normal")).distinct()
                         .select(F.col("kind").alias("_k"), F.col("normal").alias("_n")), "pii-collisions")
            if bad.isEmpty():
                return now.select("kind", "normal", "gender", "surrogate")
            on = (F.col("kind") == F.col("_k")) & (F.col("normal") == F.col("_n"))
            now = stored(drawn(now.join(bad, on, "left").withColumn(
                "attempt", F.col("attempt") + F.when(F.col("_k").isNotNull(), 1).otherwise(0))), "pii-surrogates")
        raise ValueError(f"surrogates still collide after {rounds} attempts")

    is_full = (F.col("kind") == "name") & (F.instr("normal", " ") > 0)
    out = settled(real.where(~is_full).withColumn("family", F.lit(None).cast("string")))
    named = real.where(is_full)
    if named.isEmpty():
        return out
    families = out.where("kind = 'name'").select(F.col("normal").alias("_n"), F.col("surrogate").alias("family"))
    return out.union(settled(named.join(families, _family(F.col("normal")) == F.col("_n")).drop("_n")))


def _again(normal: Column, surrogate: Column) -> Column:
    """Entries by which a text's names are found again: the full name, its family name
    and, after another mark, its given name."""
    def entry(mark: str, name: Column, new: Column) -> Column:
        return F.struct(F.concat(F.lit(mark), name).alias("_m"), new.alias("s"))
    one = F.array(entry("\x1f", normal, surrogate))
    return F.when(F.instr(normal, " ") > 0, F.concat(one, F.array(
        entry("\x1f", _family(normal), _family(surrogate)),
        entry("\x1e", F.substring_index(normal, " ", 1), F.substring_index(surrogate, " ", 1))))).otherwise(one)


def _renamed(gap: Column, m: Column) -> Column:
    """The text between mentions with its names replaced, and how many."""
    def word(run: Column, i: Column) -> Column:
        def at(mark: str, name: Column) -> Column:
            return F.element_at(m, F.concat(F.lit(mark), F.lower(name)))
        w = F.get(run, i)
        as_given = at("\x1f", F.concat(w, F.lit(" "), F.get(run, i + 1)))
        as_family = at("\x1f", F.concat(F.get(run, i - 1), F.lit(" "), w))
        new = F.coalesce(F.substring_index(as_given, " ", 1), _family(as_family), at("\x1f", w), at("\x1e", w))
        return F.struct(
            F.when(w == F.upper(w), F.upper(new)).otherwise(F.coalesce(new, w)).alias("kept"),
            (new.isNotNull() & ~(as_given.isNull() & as_family.isNotNull())).cast("int").alias("n"))

    def replaced(run: Column) -> Column:
        return let(F.split(run, " "), lambda ws: let(
            F.transform(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: word(ws, i)),
            lambda xs: F.struct(F.array_join(F.transform(xs, lambda x: x["kept"]), " ").alias("text"),
                                F.aggregate(xs, F.lit(0), lambda acc, x: acc + x["n"]).alias("n"))))

    def merged(runs: Column) -> Column:
        return let(F.split(gap, RUN, -1), lambda rest: F.struct(
            F.array_join(F.transform(rest, lambda g, i: F.concat(g, F.coalesce(F.get(runs, i)["text"], F.lit("")))), "")
            .alias("text"), F.aggregate(runs, F.lit(0), lambda acc, x: acc + x["n"]).alias("n")))
    return let(F.transform(F.regexp_extract_all(gap, F.lit(RUN), 0), replaced), merged)


def with_surrogates(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text",
                    count_col: str | None = None) -> DataFrame:
    """The documents with their entities replaced; ``count_col`` adds how many."""
    found = entities(docs, key, text_col)
    rows = docs.select(F.struct("*").alias("_doc"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                       F.xxhash64(text_col).alias("_th"))
    some = rows.where(F.col("_text").rlike(HINT))
    said = some.select("_id", "_th", F.explode(F.array_distinct(_mentions(F.col("_text")))).alias("_m")).distinct()
    said = said.select("*", _type_of(F.col("_m")).alias("_kind"))
    said = said.select("*", _normal(F.col("_kind"), F.col("_m")).alias("_normal"))
    # Mentions of a hot entity are spread by their text first; the join can be split.
    said = said.join(found, (F.col("_kind") == F.col("kind")) & (F.col("_normal") == F.col("normal")))
    entry = F.struct("_m", _formatted(F.col("kind"), F.col("_m"), F.col("surrogate")).alias("s"))
    named = F.col("kind") == "name"
    entries = F.when(named, F.concat(F.array(entry), _again(F.col("normal"), F.col("surrogate")))).otherwise(F.array(entry))

    def by_key(all_of: Column) -> Column:
        # A given name that several names of a text share has the first one's surrogate.
        return F.map_from_entries(F.filter(all_of, lambda e, i: (i == 0) | (F.get(all_of, i - 1)["_m"] != e["_m"])))
    maps = (said.select("_id", "_th", entries.alias("e"), named.alias("_named"))
            .groupBy(F.col("_id").alias("_i"), F.col("_th").alias("_t"))
            .agg(let(F.sort_array(F.flatten(F.collect_list("e"))), by_key).alias("_map"),
                 F.max("_named").alias("_names")))

    def rewritten(text: Column, m: Column) -> Column:
        def merged(found: Column) -> Column:
            plain = let(F.split(text, ANY, -1), lambda gaps: F.transform(
                gaps, lambda g: F.when(F.col("_names"), _renamed(g, m)).otherwise(
                    F.struct(g.alias("text"), F.lit(0).alias("n")))))
            return let(plain, lambda gaps: F.struct(F.array_join(F.transform(gaps, lambda g, i: F.concat(
                g["text"], F.coalesce(F.element_at(m, F.get(found, i)), F.get(found, i), F.lit("")))), "").alias("text"),
                (F.size(found) + F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x["n"])).alias("n")))
        return let(_mentions(text), merged)

    changed = some.join(maps, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_th") == F.col("_t")), "left")
    changed = changed.select("_doc", F.when(F.col("_map").isNull(), F.struct(
        F.col("_text").alias("text"), F.lit(0).alias("n"))).otherwise(
        rewritten(F.col("_text"), F.col("_map"))).alias("_r")).select("_doc", F.col("_r.text").alias("_new"), F.col("_r.n").alias("_n"))
    same = rows.where(~F.coalesce(F.col("_text").rlike(HINT), F.lit(False))).select(
        "_doc", F.col("_text").alias("_new"), F.lit(0).alias("_n"))
    out = reduce(DataFrame.union, [changed, same])
    cols = [F.col("_new").alias(c) if c == text_col else F.col("_doc").getField(c).alias(c) for c in docs.columns]
    return out.select(*cols, *([F.col("_n").cast("long").alias(count_col)] if count_col else []))

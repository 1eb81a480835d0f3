"""Surrogates for personal data and secrets; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.session import stage

# Given names whose gender and script a surrogate keeps.
GIVEN = {
    ("f", "latin"): "Mary Patricia Jennifer Linda Barbara Susan Jessica Sarah Karen Margaret Sophie Julia Claudia Ingrid Lucía Carmen Camille Amélie".split(),
    ("m", "latin"): "James Robert John Michael David William Richard Joseph Thomas Charles Hans Jürgen Klaus Pierre Jacques Carlos Miguel Javier".split(),
    ("f", "cyrillic"): "Анна Мария Ольга Елена Наталья Светлана Татьяна Ирина Екатерина Юлия".split(),
    ("m", "cyrillic"): "Иван Дмитрий Алексей Сергей Андрей Михаил Николай Владимир Павел Юрий".split(),
}
# Further given names by which names are found.
FURTHER = {
    ("f", "latin"): "Abigail Adriana Agnes Alexandra Alice Alicia Allison Amanda Amber Amelia Amy Ana Andrea Angela Anita Anke Ann Anna Anne Annette Antonia Ashley Astrid Audrey Aurélie Ava Barbara Beatriz Beatrice Bernadette Beth Betty Beverly Birgit Brenda Brittany Carla Carol Carolina Caroline Carolyn Catherine Cecilia Charlotte Chantal Cheryl Chloe Christina Christine Clara Clémence Cristina Cynthia Daniela Danielle Deborah Debra Denise Diana Diane Dolores Donna Doris Dorothy Eleanor Elena Elisabeth Elizabeth Ella Ellen Emily Emma Erika Esther Eva Evelyn Fatima Fiona Florence Frances Françoise Franziska Gabriela Gabriele Gisela Gloria Grace Greta Hannah Heather Heidi Helen Helena Helga Hélène Inés Irene Isabel Isabella Isabelle Jacqueline Jana Jane Janet Janice Jean Joan Joanna Johanna Josephine Joyce Juana Judith Judy Juliette Karin Katharina Katherine Kathleen Kathryn Katja Kelly Kimberly Kristin Laura Lauren Lea Léa Lena Leonie Lisa Lois Louise Lucy Luisa Madison Manon Manuela Marta Marie Maria María Marianne Marilyn Marion Marisol Martha Martina Megan Melanie Melissa Mercedes Mia Michelle Mónica Monika Monique Nadine Nancy Natalie Nathalie Nicole Nina Nora Olga Olivia Pamela Patricia Paula Petra Pilar Priya Rachel Raquel Rebecca Renate Rosa Rosemary Ruth Sabine Samantha Sandra Sara Sharon Shirley Silvia Simone Sofia Sofía Sonja Stefanie Stephanie Susanne Sylvie Tamara Teresa Theresa Ursula Ute Valérie Vanessa Vera Verónica Véronique Victoria Virginia Wendy Yvonne Zoe".split(),
    ("m", "latin"): "Aaron Adam Adrian Ahmed Alain Alan Albert Alberto Alejandro Alex Alexander Alfred Ali Álvaro Andre André Andreas Andrew Andrés Anthony Antoine Antonio Arthur Axel Benjamin Benoît Bernard Bernd Björn Bob Bradley Brandon Brian Bruce Bruno Bryan Carl Charlie Chris Christian Christoph Christopher Claude Craig Daniel Dennis Detlef Diego Dieter Dirk Donald Douglas Dylan Eduardo Edward Emil Emmanuel Enrique Eric Erik Ernst Ethan Étienne Eugene Felix Fernando Florian Francisco Franck François Frank Franz Fred Frédéric Friedrich Fritz Gabriel Gary Georg George Gerald Gerhard Gilles Gonzalo Gregory Günter Guillaume Harald Harold Harry Heinrich Helmut Henri Henry Herbert Holger Horst Hugo Ian Ignacio Jack Jacob Jaime Jan Jason Javier Jeffrey Jens Jeremy Jerry Jesse Jesús Jim Joachim Joe Johann Johannes Jonas Jonathan Jordan Jorge Jose José Josef Joshua Juan Julian Julien Julio Justin Karl Keith Kenneth Kevin Kyle Larry Laurent Lars Lawrence Leon Leonardo Louis Luc Luca Lucas Luis Lukas Manuel Marc Marcel Marco Marcus Mario Mark Markus Martin Mathieu Matthew Matthias Max Maximilian Mehmet Mohamed Mohammed Moritz Nathan Nicholas Nicolas Noah Norbert Oliver Olivier Oscar Otto Pablo Pascal Patrick Paul Pedro Peter Philip Philipp Philippe Rafael Rainer Ralf Ralph Ramón Raymond René Ricardo Roberto Roger Roland Rolf Ronald Roy Rudolf Russell Ryan Samuel Santiago Scott Sean Sebastian Sergio Simon Stefan Stephan Stephen Steve Steven Sven Terry Thierry Theodor Thorsten Tim Timothy Tobias Tom Tyler Udo Uwe Victor Vincent Volker Walter Wayne Werner Wilhelm Wolfgang Xavier Yves Zachary".split(),
    ("f", "cyrillic"): "Александра Алина Алла Анастасия Ангелина Валентина Валерия Вера Вероника Виктория Галина Дарья Диана Евгения Елизавета Жанна Зинаида Инна Ксения Лариса Лидия Любовь Людмила Марина Надежда Нина Оксана Полина Раиса Софья Тамара Ульяна".split(),
    ("m", "cyrillic"): "Александр Анатолий Антон Артём Борис Вадим Валентин Валерий Василий Виктор Виталий Вячеслав Геннадий Георгий Григорий Даниил Денис Евгений Егор Игорь Илья Кирилл Константин Леонид Максим Никита Олег Пётр Роман Руслан Семён Степан Фёдор Юлиан Ярослав".split(),
}
KNOWN = {kind: [*names, *FURTHER[kind]] for kind, names in GIVEN.items()}
# Titles before a name, and words that may stand before a family name.
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|г-н|г-жа|господин|госпожа"
PARTICLES = "van|von|der|den|del|della|dos|de|di|da|du|la|le|zu"
# Syllables and endings of surrogate family names.
SYLLABLES = {"latin": "bar cor del fen gar hol kel lam mor nor pel quin ros sel tam vor".split(), "cyrillic": "бор вал гор дан зар кол лив мор нов пет рад сам тих фед чер яр".split()}
ENDINGS = {("f", "latin"): "son", ("m", "latin"): "son", ("f", "cyrillic"): "ова", ("m", "cyrillic"): "ов"}

def _either(words: list[str]) -> str:
    """A pattern of the words that shares their beginnings, so that a text is compared letter by letter."""
    rest: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        rest.setdefault(word[:1], []).append(word[1:])
    ends = rest.pop("", None) is not None
    if not rest:
        return ""
    return f"(?:{'|'.join(c + _either(r) for c, r in rest.items())})" + "?" * ends


_ONE = _either([n for names in KNOWN.values() for n in names]) + r"(?!\p{L})"
# Repeated groups are possessive or bounded: others cost the JVM a stack frame for each repetition.
_PART = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}++(?:\p{Lu}\p{Ll}++)*+"
_TITLE = rf"(?:{TITLES})\.?\s+"
#: A family name: one word, or several with hyphens.
FAMILY = rf"(?<!\p{{L}}){_PART}(?!\p{{L}})(?:-{_PART}(?!\p{{L}}))*+"
_LAST = rf"(?:(?:{PARTICLES})\s+){{0,3}}{FAMILY}"
#: A known given name and a family name of one or two words; what follows a title; several initials and a family name.
NAME = (
    rf"(?<!\p{{L}})(?=[\p{{Lu}}г])(?:(?:{_TITLE})?{_ONE}(?:-{_ONE})?(?:\s+(?:\p{{Lu}}\.|{_ONE})){{0,20}}\s+{_LAST}(?: {FAMILY})?"
    rf"|{_TITLE}(?:\p{{Lu}}\.\s*){{0,20}}(?:{_PART}\s+)?{_LAST}|(?!U\.\s*[SKN]\.|E\.\s*U\.)(?:\p{{Lu}}\.\s*){{1,2}}\p{{Lu}}\.\s+{_LAST})"
)
#: What counts as an entity, in order of preference.
PATTERNS = [
    # from the start of an unbroken run, so that a long one is read once; a domain has 127 labels at most
    r"(?:\G|(?<![\p{L}\p{N}._%+\-]))[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+){0,126}\.\p{L}{2,}",
    r"(?<![\p{L}\p{N}])(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Z])",
    r"(?<=(?i:password|passwd|pwd|token|secret|api_key|apikey)\s{0,2}[=:]\s{0,2}[\x22']?)(?=[_\-./+]*[A-Za-z0-9])[A-Za-z0-9_\-./+]{6,}",
    r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\p{N}])",
    r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    r"(?<![\p{L}\p{N}])\+\d{1,3}[ .\-]?\(?\d{1,4}\)?(?:[ .\-]?\d{2,4}){2,4}(?!\d)",
    r"(?<!\d)\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\d)",
    r"(?<!\d)\d{3}[ .\-]\d{3}[ .\-]\d{4}(?!\d)",
    r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    r"(?<!\d)\d(?:[ \-]?\d){12,18}(?!\d)",
    r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    NAME,
]
ENTITY = "|".join(PATTERNS)
#: A text without any of these has no entity: all but names have a digit or an at sign, or follow one of these words.
HINT = r"[0-9@]|(?i:password|passwd|pwd|token|secret|api_key|apikey)\s{0,2}[=:]|" + NAME

#: Tries after which a surrogate gets one character, octet or syllable longer.
LONGER = 4
#: Tries that no entity reaches: the last ones draw from some 50 more characters than the entity has.
ATTEMPTS = 200

_DIGITS = ("phone", "card", "ssn")


def entity_kind(mention: Column) -> Column:
    kinds = [
        ("email", mention.contains("@")),
        ("key", mention.rlike(r"^(?:AKIA|ASIA)[0-9A-Z]{16}$")),
        ("ip", mention.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$")),
        ("ssn", mention.rlike(r"^\d{3}-\d{2}-\d{4}$")),
        ("phone", mention.rlike(r"^[+(][\d ().\-]*$|^\d{3}[ .\-]\d{3}[ .\-]\d{4}$")),
        ("card", mention.rlike(r"^\d(?:[ \-]?\d){12,18}$")),
        ("iban", mention.rlike(r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$")),
        ("name", mention.rlike(r"^\p{L}[^\d@]*\s[^\d@]*$")),
    ]
    out = F.lit(None).cast("string")
    for kind, test in reversed(kinds):
        out = F.when(test, F.lit(kind)).otherwise(F.coalesce(out, F.lit("secret")))
    return out


def _untitled(mention: Column) -> Column:
    return F.regexp_replace(mention, "^" + _TITLE, "")


def canonical(kind: Column, mention: Column) -> Column:
    """What mentions of one entity have in common, whatever their punctuation or case."""
    return (
        F.when(kind.isin(*_DIGITS), F.regexp_replace(mention, r"\D", ""))
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .when(kind == "email", F.lower(mention))
        .when(kind == "name", F.lower(F.regexp_replace(F.regexp_replace(_untitled(mention), r"\s+\p{Lu}\.(?=\s)", ""), r"\s+", " ")))
        .otherwise(mention)
    )


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it occurs there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _characters(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _byte(stream: Column, at: Column) -> Column:
    return F.conv(F.substring(stream, at % 128 * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _letter(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), number % len(alphabet) + 1, F.lit(1))


def _shaped(value: Column, stream: Column, hexadecimal: Column, kept_from: Column) -> Column:
    """Every digit and letter replaced by another of its class and script; from ``kept_from`` on nothing."""

    def swap(c: Column, i: Column) -> Column:
        n = _byte(stream, i)
        return (
            F.when(i >= kept_from, c)
            .when(hexadecimal & c.rlike("[0-9a-f]"), _letter("0123456789abcdef", n))
            .when(hexadecimal & c.rlike("[0-9A-F]"), _letter("0123456789ABCDEF", n))
            .when(c.rlike("[0-9]"), _letter("0123456789", n))
            .when(c.rlike("[а-яё]"), _letter("абвгдежзиклмнопрстуфхцчшэюя", n))
            .when(c.rlike("[А-ЯЁ]"), _letter("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", n))
            .when(c.rlike(r"\p{Lu}"), _letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
            .when(c.rlike(r"\p{L}"), _letter("abcdefghijklmnopqrstuvwxyz", n))
            .otherwise(c)
        )

    return F.array_join(F.transform(_characters(value), swap), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of all digits; a number is valid if it is a multiple of ten."""
    doubled = F.transform(
        _characters(F.reverse(digits)),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10


def _longer(attempt: Column) -> Column:
    return F.floor(attempt / LONGER).cast("int")


def _name(value: Column, stream: Column, attempt: Column) -> Column:
    given = F.substring_index(F.substring_index(value, " ", 1), "-", 1)
    cyrillic, female = value.rlike("[а-яё]"), given.rlike("[aая]$")
    out = F.lit(None).cast("struct<sure:int,name:string>")
    for (gender, script), names in GIVEN.items():
        own = [n.lower() for n in names]
        first = F.element_at(F.array(*map(F.lit, own)), _byte(stream, F.lit(0)) % len(own) + 1)
        syllables = F.array(*map(F.lit, SYLLABLES[script]))
        # more tries, longer names: there is always a free one
        parts = F.transform(F.sequence(F.lit(1), F.lit(2) + _longer(attempt)), lambda i: F.element_at(syllables, _byte(stream, i) % len(SYLLABLES[script]) + 1))
        family = F.concat(F.array_join(parts, ""), F.lit(ENDINGS[gender, script]))
        known = given.isin([n.lower() for n in KNOWN[gender, script]])
        guessed = (cyrillic == F.lit(script == "cyrillic")) & (female == F.lit(gender == "f"))
        drawn = F.when(value.contains(" "), F.concat(first, F.lit(" "), family)).otherwise(family)
        out = F.when(known, F.struct(F.lit(1).alias("sure"), drawn.alias("name"))).when(guessed & out.isNull(), F.struct(F.lit(0).alias("sure"), drawn.alias("name"))).otherwise(out)
    return out["name"]


def candidate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """A replacement of the entity's kind and format, drawn by the key.

    It keeps the length for ``LONGER`` tries, then grows: however few values a format has and however
    many of them the corpus holds, there is a free one.
    """
    longer, given = _longer(attempt), value
    more = F.when(kind == "email", F.concat(F.repeat(F.lit("a"), longer), value)).when(kind.isin("name", "ip"), value).otherwise(F.concat(value, F.repeat(F.lit("0"), longer)))
    stream = F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), kind, given, attempt.cast("string"), F.lit(str(i))), 256) for i in range(4)])

    def drawn(value: Column, stream: Column) -> Column:
        no, never = F.lit(False), F.lit(1 << 30)
        hexadecimal = (kind == "secret") & given.rlike("^(?:(?=.*[a-f])[0-9a-f]+|(?=.*[A-F])[0-9A-F]+)$")
        top_domain = F.length(value) - F.length(F.substring_index(value, ".", -1))
        octets = [(_byte(stream, F.lit(0)) % 223 + 1), _byte(stream, F.lit(1)), _byte(stream, F.lit(2)), _byte(stream, F.lit(3)) % 254 + 1]
        further = F.transform(F.sequence(F.lit(0), longer), lambda i: F.when(i > 0, F.concat(F.lit("."), _byte(stream, i + 3).cast("string"))).otherwise(""))
        number = F.concat(F.substring(value, 1, 1), _shaped(F.substring(value, 2, 1000), stream, no, never))

        def checked(number: Column) -> Column:
            body = F.substring(number, F.lit(1), F.length(number) - 1)
            return F.concat(body, F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))

        return (
            F.when(kind == "email", _shaped(value, stream, no, top_domain))
            .when(kind == "ip", F.concat(F.concat_ws(".", *octets), F.array_join(further, "")))
            .when(kind == "card", F.when(_luhn(given) == 0, _bound(number, checked)).otherwise(number))
            .when((kind == "phone") & (F.length(given) > 10), number)
            .when(kind.isin("iban", "key"), F.concat(F.substring(value, 1, 4), _shaped(F.substring(value, 5, 1000), stream, no, never)))
            .when(kind == "name", _name(value, stream, attempt))
            .otherwise(_shaped(value, stream, hexadecimal, never))
        )

    return _bound(F.struct(more.alias("value"), stream.alias("stream")), lambda b: drawn(b["value"], b["stream"]))


def rendered(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the punctuation and case of one mention."""
    slot = F.when(kind == "iban", "[0-9A-Z]").otherwise("[0-9]")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("used"))
    filled = F.aggregate(
        _characters(mention),
        start,
        lambda s, c: F.when(
            F.regexp_like(c, slot), F.struct(F.concat(s["out"], F.substring(surrogate, s["used"] + 1, F.lit(1))).alias("out"), (s["used"] + 1).alias("used"))
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["used"].alias("used"))),
        lambda s: F.concat(s["out"], F.substring(surrogate, s["used"] + 1, F.length(surrogate))),
    )
    first = F.when(surrogate.contains(" "), F.concat(F.initcap(F.substring_index(surrogate, " ", 1)), F.regexp_extract(_untitled(mention), r"\s+", 0))).otherwise("")
    spaced = F.concat(F.regexp_extract(mention, "^" + _TITLE, 0), first, F.initcap(F.substring_index(surrogate, " ", -1)))
    return (
        F.when(kind.isin(*_DIGITS, "iban"), filled)
        .when(kind == "name", spaced)
        .when((kind == "email") & (mention == F.upper(mention)), F.upper(surrogate))
        .otherwise(surrogate)
    )


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, value, surrogate`` of distinct ``kind, value`` rows.

    No surrogate equals an entity of the corpus or another one's surrogate. Of entities that draw the
    same candidate the first by value keeps it, the others draw again.
    """
    entities = stage(entities.distinct(), "pii-entities")
    real = entities.select("kind", F.col("value").alias("surrogate"))
    waiting, done = entities.withColumn("attempt", F.lit(0)), None
    for attempt in range(ATTEMPTS):
        drawn = waiting.withColumn("surrogate", candidate(key, F.col("kind"), F.col("value"), F.col("attempt")))
        free = drawn.join(real, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate")
        done = stage(first if done is None else done.unionByName(first), "pii-surrogates")
        waiting = entities.join(done, ["kind", "value"], "left_anti").withColumn("attempt", F.lit(attempt + 1))
        if waiting.isEmpty():
            return done
    raise RuntimeError(f"no free surrogates after {ATTEMPTS} tries")


def _families(named: DataFrame) -> DataFrame:
    """``digest, families``: of each text, the words of the family names found in it and what replaces them."""
    words = F.regexp_extract_all(_untitled(F.col("mention")), F.lit(FAMILY), F.lit(0))
    own = F.when((F.size(words) > 1) & F.col("value").contains(" ") & ~F.col("value").rlike(r"^\p{L}\."), F.slice(words, 2, 100)).otherwise(words)
    shown = F.initcap(F.substring_index("surrogate", " ", -1))
    # a full name settles what a family name after a title becomes
    found = named.where(F.col("kind") == "name").select("digest", F.explode(own).alias("family"), F.struct(~F.col("value").contains(" "), shown.alias("shown")).alias("as"))
    one = found.groupBy("digest", "family").agg(F.min("as")["shown"].alias("shown"))
    return one.groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("family", "shown"))).alias("families"))


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The documents with every entity in ``text`` replaced, and ``n_entities, entity_kinds`` added.

    Mentions of one entity get one surrogate in all documents, in the punctuation and case of each
    mention; different entities get different ones. A family name that was found with a given name or
    title is replaced wherever it stands alone in the same text. Surrogates depend on ``key`` and on which entities
    the corpus has, so reruns agree. A NULL or empty text and texts without entities stay as they are.
    Repeated rows are replaced alike; an empty table gives no rows. Very long texts are searched whole; a
    domain of more than 127 labels, or more than 20 initials and given names before a family name, make
    no entity. Columns of ``docs`` named like the
    added ones are overwritten, all others are kept.

    Only documents with entities are shuffled, by a digest of their text; equal texts share one map.
    """
    columns = [c for c in docs.columns if c not in ("n_entities", "entity_kinds")]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    content = F.col("row").getField(text)
    mentions = F.when(content.rlike(HINT), F.regexp_extract_all(content, F.lit(ENTITY), F.lit(0)))
    packed = packed.withColumn("mentions", mentions)
    has = F.coalesce(F.size("mentions") > 0, F.lit(False))
    found = stage(packed.where(has).withColumn("digest", F.md5(content.cast("binary"))), "pii-documents")
    said = found.select("digest", F.explode("mentions").alias("mention")).distinct()
    said = said.withColumn("kind", entity_kind(F.col("mention"))).withColumn("value", canonical(F.col("kind"), F.col("mention")))
    surrogates = assign_surrogates(said.select("kind", "value"), key)
    named = said.join(surrogates, ["kind", "value"]).withColumn("shown", rendered(F.col("kind"), F.col("mention"), F.col("surrogate")))
    maps = named.groupBy("digest").agg(
        F.map_from_entries(F.collect_list(F.struct("mention", "shown"))).alias("shown"), F.array_sort(F.collect_set("kind")).alias("kinds")
    )
    joined = found.join(maps, "digest").join(_families(named), "digest", "left")
    between = F.split(content, ENTITY, -1)
    families, title = F.col("families"), "^" + _TITLE
    words = lambda p: F.regexp_extract_all(p, F.lit(FAMILY), F.lit(0))
    swapped = lambda p: F.zip_with(F.split(p, FAMILY, -1), words(p), lambda g, w: F.concat(g, F.coalesce(families[w], w, F.lit(""))))
    lone = lambda p: F.when(families.isNull() | p.isNull(), p).otherwise(F.array_join(swapped(p), ""))
    # a title and a family name: that of the full name, if there is one
    titled = lambda m: F.when(m.rlike(title + FAMILY + "$"), F.concat(F.regexp_extract(m, title, 0), families[_untitled(m)]))
    pieces = F.zip_with(between, "mentions", lambda p, m: F.concat(lone(p), F.coalesce(titled(m), F.element_at(F.col("shown"), m), F.lit(""))))
    replaced = F.array_join(pieces, "")
    alone = F.aggregate(between, F.lit(0), lambda n, p: n + F.size(F.filter(words(p), lambda w: families[w].isNotNull())))
    number = F.size("mentions") + F.when(families.isNull(), 0).otherwise(alone)
    others = packed.where(~has)
    return others.select("row.*", F.lit(0).alias("n_entities"), F.array().cast("array<string>").alias("entity_kinds")).unionByName(
        joined.select(
            *[replaced.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns], number.alias("n_entities"), F.col("kinds").alias("entity_kinds")
        )
    )

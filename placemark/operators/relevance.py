"""Event relevance from source categories and keywords."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placemark.functions.text import first_listed

# Keyword lists; the first hit in a list's order is reported.
HARD_NEGATIVE = (
    "sajam", "sajamski", "expo", "bazar", "vasar", "konferencija", "kongres", "samit", "seminar", "predavanje", "radionica", "webinar", "trening", "obuka",
    "izlozba", "izlozbe", "postavka", "projekcija", "bioskop", "predstava", "predstave", "opera", "balet", "mjuzikl", "monodrama", "matine",
    "utakmica", "mec", "turnir", "trka", "maraton", "sampionat", "prvenstvo", "kviz", "deciji", "decija", "decji", "decje", "supercar", "oldtajmer", "reli",
)
STRONG = (
    "koncert", "koncerti", "koncerta", "koncertu", "koncertom", "koncertima", "concert", "nastup", "nastupa", "nastupom", "svirka", "svirke", "svirku", "live", "uzivo",
    "tribute", "tributes", "orkestar", "orkestra", "orkestrom", "orchestra", "bend", "benda", "bendom", "bendovi", "bendova", "band", "dj", "djs", "b2b", "rave", "techno",
    "tehno", "house", "trance", "elektronska", "electronic", "clubbing", "soundsystem", "sound", "warmup", "afterparty", "album", "albuma", "singl", "spot", "turneja",
    "turneje", "turneju", "tour", "unplugged", "acoustic", "akusticni", "akusticno", "akusticna", "jam", "music", "muzika", "muzike", "muziku", "muzikom", "muzicki",
    "jazz", "dzez", "blues", "bluz", "rock", "punk", "reggae", "hiphop", "hop", "rap", "disco", "funk",
)
SECONDARY = (
    "zurka", "zurke", "party", "partijem", "fest", "festival", "openair", "open", "standup", "stand", "komedija", "kabare", "cabaret", "improvizacija", "docek",
    "nocna", "noc", "night",
)
FESTIVAL, NIGHT = ("fest", "festival"), ("nocna", "noc", "night")
NON_MUSIC = (
    "vina", "vinski", "vino", "wine", "piva", "beer", "hrane", "food", "gastro", "street", "knjiga", "knjige", "knjizevni", "book", "film", "filmski", "filma",
    "filmova", "pozorisni", "pozorista", "teatarski", "naucni", "nauke", "science", "cveca", "turisticki",
)
KIDS = ("deciji", "decija", "decji", "decje", "dete", "deca")
CATEGORIES = {"music": "koncert", "festival": "festival", "standup": "stand-up", "newyear": "docek", "theatre": "pozoriste", "sport": "sport"}


def relevance(categories: Column, tokens: Column, words: dict[str, tuple[str, ...]] | None = None, names: dict[str, str] | None = None) -> Column:
    """struct(accepted, tier, reason, keyword): editors' categories first, then keywords.

    words and names replace the lists above for other corpora.
    """
    w = {"hard": HARD_NEGATIVE, "strong": STRONG, "secondary": SECONDARY, "festival": FESTIVAL, "night": NIGHT, "nonmusic": NON_MUSIC, "kids": KIDS} | (words or {})
    c = CATEGORIES | (names or {})
    own = F.transform(categories, F.lower)
    has = lambda k: F.array_contains(own, c[k])
    hit = {k: first_listed(v, tokens) for k, v in w.items()}
    party = F.coalesce(first_listed(tuple(x for x in w["secondary"] if x != c["newyear"] and x not in w["night"]), tokens), hit["strong"])
    beyond = first_listed(tuple(x for x in w["secondary"] if x not in w["festival"]), tokens)
    negative = F.coalesce(hit["hard"], hit["kids"])

    def out(accepted: bool, tier: str | None, reason: str, keyword: Column | None = None) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(F.lit(accepted).alias("accepted"), (F.lit(tier) if tier else none).alias("tier"), F.lit(reason).alias("reason"), (none if keyword is None else keyword).alias("keyword"))

    vetoed = hit["nonmusic"].isNotNull() & beyond.isNull()
    return (
        F.when(has("music"), out(True, "primary", "category"))
        .when(
            has("festival"),
            F.when(hit["strong"].isNotNull(), out(True, "primary", "festival with music", hit["strong"]))
            .when(hit["nonmusic"].isNotNull(), out(False, None, "festival of something else", hit["nonmusic"]))
            .when(hit["kids"].isNotNull(), out(False, None, "kids", hit["kids"]))
            .otherwise(out(True, "secondary", "festival")),
        )
        .when(has("standup"), F.when(hit["kids"].isNotNull(), out(False, None, "kids", hit["kids"])).otherwise(out(True, "secondary", "category")))
        .when(
            has("newyear"),
            F.when(hit["kids"].isNotNull(), out(False, None, "kids", hit["kids"]))
            .when(party.isNotNull(), out(True, "secondary", "new year party", party))
            .otherwise(out(False, None, "new year without a party")),
        )
        .when(has("theatre") | has("sport"), out(False, None, "category"))
        .when(negative.isNotNull(), out(False, None, "hard negative", negative))
        .when(hit["strong"].isNotNull(), out(True, "primary", "music", hit["strong"]))
        .when(hit["secondary"].isNotNull() & vetoed, out(False, None, "festival of something else", hit["nonmusic"]))
        .when(hit["secondary"].isNotNull(), out(True, "secondary", "nightlife", hit["secondary"]))
        .otherwise(out(False, None, "no signal"))
    )

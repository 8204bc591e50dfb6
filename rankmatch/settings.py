"""Column names, rank levels and rule tables the operators take as defaults."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Names, literals and rules that the results depend on.
# ---------------------------------------------------------------------------

# Ranks, finest first.
RANKS = (
    "infraspecificEpithet",
    "specificEpithet",
    "genus",
    "family",
    "order",
    "class",
    "phylum",
    "kingdom",
)

RECORD_ID = "speciesID"
NODE_ID = "taxonID"
ACCEPTED_ID = "acceptedNameUsageID"
MATCHED_ID = "matched_taxonID"
PARENT_ID = "parentNameUsageID"
CANONICAL = "canonicalName"
STATUS = "taxonomicStatus"
NODE_RANK = "taxonRank"

# Key of the exact match.
EXACT_KEYS = ("genus", "specificEpithet", "infraspecificEpithet")

# Statuses of nodes that may be matched exactly.
MATCHABLE_STATUSES = (
    "accepted",
    "synonym",
    "homotypic synonym",
    "proparte synonym",
    "heterotypic synonym",
)

# Kingdoms whose nodes may become parents.
PARENT_KINGDOMS = ("Animalia", "Plantae")

# Header names of the raw checklist and what they are called afterwards.
RENAMES = {
    "data cleanup changes": "data cleanup changes 1",
    "species": "specificEpithet",
    "subspecies": "infraspecificEpithet",
    "domain ": "domain",
}

# Columns of the raw checklist that only log earlier edits.
LOG_COLUMNS = (
    "cleanup changes ",
    "Data cleanup changes",
    "data cleanup changes 1",
    "changes",
    "cleanup changes",
    "Unnamed: 18",
    "Unnamed: 17",
    "Unnamed: 19",
    "query",
    "query ",
    "issue",
    "cleanup changes/comments",
    "subphylum",
)

LOG_PREFIX = "Unnamed"

MARKUP = ("<i>", "</i>")

DOMAIN = "Eukarya"

# Kingdom by phylum; every other phylum, and no phylum, is DEFAULT_KINGDOM.
KINGDOM_BY_PHYLUM = {
    "fungi": ("Ascomycota", "Basidiomycota"),
    "Bacteria": ("Cyanobacteria",),
    "Protista": ("Ciliophora",),
}
DEFAULT_KINGDOM = "Animalia"

# (genericName, specificEpithet as found, corrected epithet)
EPITHET_CORRECTIONS = (
    ("Glenea", "mathemathica", "mathematica"),
    ("Bavia", "sexupunctata", "sexpunctata"),
    ("Omoedus", "ephippigera", "ephippiger"),
    ("Byblis", "kallartha", "kallarthra"),
    ("Alcockpenaeopsis", "hungerfordi", "hungerfordii"),
    ("Pseudosesarma", "edwardsi", "edwardsii"),
    ("Urocaridella", "antonbruuni", "antonbruunii"),
    ("Ocypode", "cordimanus", "cordimana"),
)

# The same pair can set the infraspecific epithet as well.
INFRASPECIFIC_CORRECTIONS = (("Glenea", "mathemathica", "mathematica"),)

# Literals written into records that still lack a node.
UNMATCHED_LABELS = {
    "taxonRank": "BOSuncornirmedSpecies",
    "taxonomicStatus": "BOSunformired",
}

# Columns of a matched record, in output order.
MATCH_COLUMNS = (
    "speciesID",
    "matched_taxonID",
    "acceptedNameUsageID",
    "taxonName",
    "domain",
    "kingdom",
    "phylum",
    "class",
    "subclass",
    "superorder",
    "order",
    "sub-order",
    "infraorder",
    "section",
    "subsection",
    "superfamily",
    "family",
    "subfamily",
    "tribe",
    "genus",
    "subgenus",
    "genericName",
    "specificEpithet",
    "infraspecificEpithet",
)

OUTPUT_COLUMNS = MATCH_COLUMNS + ("taxonRank", "taxonomicStatus", "parentNameUsageID")

# Rank compared when a name shared by several nodes has a single record.
TIE_RANK = "genus"
TIE_COLUMNS = (
    "class",
    "order",
    "family",
    "genus",
    "specificEpithet",
    "infraspecificEpithet",
)


@dataclass(frozen=True)
class Correction:
    """Set ``column`` to ``value`` where every column of ``when`` has the given value."""

    column: str
    when: tuple[tuple[str, str], ...]
    value: str


@dataclass(frozen=True)
class Level:
    """How records of one depth find a parent.

    A record belongs to the level when all of ``filled`` are non-empty and all of
    ``blank`` are empty.  A node serves it when all of ``node_null`` are null and all of
    ``node_filled`` are not, its rank is not ``node_rank_not``, and, for every column of
    ``within``, its value occurs among the records of the level.
    """

    name: str
    keys: tuple[str, ...]
    filled: tuple[str, ...]
    blank: tuple[str, ...]
    node_null: tuple[str, ...] = ()
    node_filled: tuple[str, ...] = ()
    node_rank_not: str | None = None
    within: tuple[str, ...] = ()


# The seven levels, coarsest first.  They exclude one another.
LEVELS = (
    Level(
        name="phylum",
        keys=("phylum",),
        filled=("phylum",),
        blank=RANKS[:6],
        node_null=RANKS[:6],
    ),
    Level(
        name="class",
        keys=("class",),
        filled=("class",),
        blank=RANKS[:5],
        node_null=RANKS[:5],
    ),
    Level(
        name="order",
        keys=("order",),
        filled=("class", "order"),
        blank=RANKS[:4],
        node_null=RANKS[:4],
    ),
    Level(
        name="family",
        keys=("family",),
        filled=("class", "order", "family"),
        blank=RANKS[:3],
        node_null=RANKS[:3],
        within=("order",),
    ),
    Level(
        name="genus",
        keys=("genus",),
        filled=("class", "order", "family", "genus"),
        blank=RANKS[:2],
        node_null=RANKS[:2],
        node_rank_not="species",
    ),
    Level(
        name="specificEpithet",
        keys=("specificEpithet", "genus"),
        filled=("class", "order", "family", "genus", "specificEpithet"),
        blank=RANKS[:1],
        node_filled=("infraspecificEpithet",),
    ),
    Level(
        name="infraspecificEpithet",
        keys=("infraspecificEpithet", "genus"),
        filled=("class", "order", "family", "genus", "infraspecificEpithet"),
        blank=(),
    ),
)


def default_corrections() -> list[Correction]:
    """The correction rules above as :class:`Correction` values."""
    tables = (
        ("infraspecificEpithet", INFRASPECIFIC_CORRECTIONS),
        ("specificEpithet", EPITHET_CORRECTIONS),
    )
    return [
        Correction(column, (("genericName", generic), ("specificEpithet", found)), value)
        for column, rules in tables
        for generic, found, value in rules
    ]

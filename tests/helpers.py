"""Small tables as lists of dicts, and plain loops to compare with."""

from rankmatch import settings as S

RANKS = list(S.RANKS)
COARSE = RANKS[::-1]


def frame(spark, rows, ddl):
    names = [part.strip().rsplit(" ", 1)[0].strip("`") for part in ddl.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def record(record_id, **ranks):
    out = {r: "" for r in RANKS}
    out.update({"class" if k == "class_" else k: v for k, v in ranks.items()})
    return {"speciesID": record_id, **out}


def node(node_id, canonical=None, rank="x", status="accepted", accepted=None, **ranks):
    out = {r: None for r in RANKS}
    out.update({"class" if k == "class_" else k: v for k, v in ranks.items()})
    return {
        "taxonID": node_id,
        "acceptedNameUsageID": accepted,
        "taxonRank": rank,
        "taxonomicStatus": status,
        "canonicalName": canonical,
        "genericName": out["genus"],
        **out,
    }


_RANK_DDL = ", ".join(f"`{r}` string" for r in RANKS)
RECORD_DDL = f"speciesID string, {_RANK_DDL}"
NODE_DDL = (
    "taxonID long, acceptedNameUsageID long, taxonRank string, taxonomicStatus string,"
    f" canonicalName string, genericName string, {_RANK_DDL}"
)


def records_frame(spark, records):
    return frame(spark, records, RECORD_DDL)


def nodes_frame(spark, nodes):
    return frame(spark, nodes, NODE_DDL)


def loop_homonyms(records, nodes, kingdoms, ranks=RANKS, tie=S.TIE_RANK, six=S.TIE_COLUMNS):
    """Record id to parent id, by going through records one at a time."""
    named = {}
    for n in sorted(nodes, key=lambda n: n["taxonID"]):
        if n["taxonomicStatus"] == "accepted" and n["kingdom"] in kingdoms and n["canonicalName"]:
            full = {r: n[r] or "" for r in ranks}
            named.setdefault(n["canonicalName"], []).append({**full, "id": n["taxonID"]})

    def target(r):
        for rank in ranks:
            if r[rank]:
                return rank, r[rank]
        return None

    seats = {}
    for r in records:
        seats.setdefault(target(r), []).append(r)
    found = {}
    for r in records:
        place = target(r)
        if place is None:
            continue
        rank, name = place
        group = named.get(name, [])
        if len(group) < 2 or not any(n[q] == name for n in group for q in ranks):
            continue
        finer = ranks[ranks.index(rank) - 1] if rank != ranks[0] else None
        open_nodes = [n for n in group if finer is not None and not n[finer]]
        if not open_nodes:
            continue
        chosen = open_nodes[0]
        other = group[1] if group[0] is chosen else group[0]
        if rank == tie and len(seats[place]) == 1:
            equals = [all(r[c] == n[c] for c in six) for n in (chosen, other)]
            if equals == [False, True]:
                chosen = other
        found[r["speciesID"]] = chosen["id"]
    return found


def loop_levels(records, nodes, kingdoms):
    """All (record id, level, parent id), level by level."""
    pool = [
        n
        for n in nodes
        if n["taxonomicStatus"] == "accepted" and n["taxonRank"] not in (None, "unranked") and n["kingdom"] in kingdoms
    ]
    coarse = ["class", "order", "family", "genus", "specificEpithet", "infraspecificEpithet"]
    shapes = {
        "phylum": ({"phylum"}, set(coarse)),
        "class": ({"class"}, set(coarse[1:])),
        "order": (set(coarse[:2]), set(coarse[2:])),
        "family": (set(coarse[:3]), set(coarse[3:])),
        "genus": (set(coarse[:4]), set(coarse[4:])),
        "specificEpithet": (set(coarse[:5]), set(coarse[5:])),
        "infraspecificEpithet": ({"class", "order", "family", "genus", "infraspecificEpithet"}, set()),
    }
    out = []
    for level, (full, empty) in shapes.items():
        wanted = [r for r in records if all(r[c] for c in full) and not any(r[c] for c in empty)]
        for n in pool:
            if level == "specificEpithet":
                fits = n["infraspecificEpithet"] is not None
            elif level == "infraspecificEpithet":
                fits = True
            else:
                below = (["phylum"] + coarse)[(["phylum"] + coarse).index(level) + 1 :]
                fits = all(n[c] is None for c in below)
            if level == "genus":
                fits = fits and n["taxonRank"] != "species"
            if level == "family":
                fits = fits and n["order"] in {r["order"] for r in wanted}
            keys = [level, "genus"] if level in coarse[4:] else [level]
            if not fits:
                continue
            out += [
                (r["speciesID"], level, n["taxonID"])
                for r in wanted
                if all(n[k] is not None and n[k] == r[k] for k in keys)
            ]
    return sorted(out)

"""Hand-made raw inputs with the edge rows of FIXTURES.md, written as the
reference's file layout: ``{REGION}videos.csv`` and ``{REGION}_category_id.json``."""

import json
import os

HEADER = ["video_id", "trending_date", "title", "channel_title", "category_id", "publish_time", "tags",
          "views", "likes", "dislikes", "comment_count", "thumbnail_link", "comments_disabled",
          "ratings_disabled", "video_error_or_removed", "description"]


def row(vid, date, views, likes=1, dislikes=1, comments=1, cat="10", pub="2017-11-13T17:13:01.000Z",
        title="t", channel="ch", tags="a|b", desc="d", flags=("False", "False", "False")):
    v = lambda x: "" if x is None else str(x)
    return [vid, date, title, channel, v(cat), pub, v(tags), v(views), v(likes), v(dislikes), v(comments),
            "http://x/" + vid, *flags, v(desc)]


def q(field: str) -> str:
    if any(c in field for c in ',"\n'):
        return '"' + field.replace('"', '""') + '"'
    return field


def write_csv(path, header, data, encoding="utf-8"):
    lines = [",".join(header)] + [",".join(q(f) for f in r) for r in data]
    with open(path, "wb") as fh:
        fh.write(("\n".join(lines) + "\n").encode(encoding))


def us_rows():
    return [
        row("a", "17.14.11", 100, 5, 0, 0),                       # plain
        row("a", "17.14.11", 100, 5, 0, 0),                       # exact duplicate
        row("b", "17.14.11", 300, desc=None),                     # dup key, null description ...
        row("b", "17.14.11", 300, desc="No description provided"),  # ... equals filler -> collapses
        row("c", "17.14.11", 50), row("c", "17.14.11", 70),        # same key, higher views wins
        row("d", "17.14.11", None), row("d", "17.14.11", 10),      # null views loses
        row("e", "bad", 10), row("f", "", 10),                    # bad trending_date -> dropped
        row("g", "17.14.11", 10, pub="garbage"),                  # bad publish_time -> dropped
        row("h", "17.14.11", 10, cat=None),                       # null category -> dropped
        row("i", "17.15.11", 4000, 5, 0, 0, cat="12.0"),          # float category, 0.00125 -> 0.0012
        row("j", "17.15.11", 0), row("k", "17.15.11", -5, -1, -2, -3),  # zero / negative counters
        row("l", "17.15.11", 10, likes=None),                     # null likes: engagement 0.2
        row("m", "17.15.11", 10, cat="77"),                       # category missing from dimension
        row("n", "17.16.11", 10, title='quote "x", comma\nnewline'),  # quoted field
    ]


def write_raw(root, latin1_fr=True, mixed_case=True, missing=("IN",)):
    os.makedirs(root, exist_ok=True)
    header = list(HEADER)
    if mixed_case:
        header = [h.upper() if h in ("views", "title") else h for h in header]
    write_csv(os.path.join(root, "USvideos.csv"), header, us_rows())
    # FR: another column order, Latin-1 bytes
    order = list(reversed(range(len(HEADER))))
    fr = [row("z", "17.14.11", 20, title="café")]
    write_csv(os.path.join(root, "FRvideos.csv"), [HEADER[i] for i in order],
              [[r[i] for i in order] for r in fr], encoding="latin-1" if latin1_fr else "utf-8")
    cats = {"US": [("10", "Music"), ("12", "Pets"), ("x", "Broken id")],
            "FR": [("10", "Musique"), ("22", "People")]}
    for region, items in cats.items():
        with open(os.path.join(root, f"{region}_category_id.json"), "w") as fh:
            json.dump({"items": [{"id": i, "snippet": {"title": t}} for i, t in items]}, fh, indent=2)
    with open(os.path.join(root, "GB_category_id.json"), "w") as fh:
        fh.write("{ not json")
    with open(os.path.join(root, "CA_category_id.json"), "w") as fh:
        json.dump({"kind": "no items"}, fh)
    return ["US", "CA", "GB", "IN", "DE", "FR"]

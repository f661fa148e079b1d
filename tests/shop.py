"""Small event frames and a plain Python account of the expected features."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta

from sessionloom.schema import EVENT_SCHEMA, FEATURE_COLUMNS

DAY = datetime(2019, 10, 1)


def at(clock: str, day: int = 1) -> datetime:
    hours, minutes, seconds = (int(part) for part in clock.split(":"))
    return DAY + timedelta(days=day - 1, hours=hours, minutes=minutes, seconds=seconds)


def event(time, kind="view", product="p1", session="s1", user="u1", price=10.0, brand="b", category="c"):
    if isinstance(time, str):
        time = at(time)
    return (time, kind, product, "0", category, brand, price, user, session)


def frame(spark, events):
    return spark.createDataFrame(events, EVENT_SCHEMA)


def rows_of(df):
    """Feature rows as dictionaries in a fixed order."""
    found = [row.asDict() for row in df.collect()]
    return sorted(found, key=lambda row: tuple(repr(row[name]) for name in FEATURE_COLUMNS))


def _nulls_first(*values):
    return tuple((value is not None, value) if value is not None else (False, 0) for value in values)


def expected_features(events, start=None, end=None, session_level=False):
    users = defaultdict(set)
    for e in events:
        users[e[8]].add(e[7])
    kept = [
        e for e in events
        if e[8] is not None and len(users[e[8]]) == 1
        and (start is None or (e[0] is not None and e[0] >= start))
        and (end is None or (e[0] is not None and e[0] <= end))
    ]
    by_session, by_variant = defaultdict(list), defaultdict(list)
    for e in kept:
        by_session[e[8]].append(e)
        if e[1] in ("view", "purchase"):
            by_variant[(e[8], e[2], e[4], e[5], e[6])].append(e)

    def first(session):
        return min((e[0] for e in by_session[session] if e[0] is not None), default=None)

    def owner(session):
        return by_session[session][0][7]

    def earlier(session):
        place = _nulls_first(first(session), session)
        return sum(
            1 for other in by_session
            if owner(other) == owner(session) and _nulls_first(first(other), other) < place
        )

    def views(group):
        return sum(e[1] == "view" for e in group)

    def place(variant):
        session, _, category, brand, price = variant
        rest = () if session_level else (category, brand, price)
        return _nulls_first(first(session), session, *rest)

    features = []
    for variant, group in by_variant.items():
        session, product, category, brand, price = variant
        times = [e[0] for e in by_session[session] if e[0] is not None]
        before = [
            views(other_group) for other, other_group in by_variant.items()
            if other[1] == product and owner(other[0]) == owner(session) and place(other) < place(variant)
        ]
        viewed = {e[2] for e in by_session[session] if e[1] == "view" and e[2] is not None}
        features.append(
            dict(
                zip(
                    FEATURE_COLUMNS,
                    (
                        session, product, category, brand, price,
                        int(any(e[1] == "purchase" for e in group)), views(group),
                        owner(session), len(viewed),
                        times and f"{min(times):%H:%M}" or None,
                        times and f"{min(times):%A}" or None,
                        int((max(times) - min(times)).total_seconds()) if times else None,
                        earlier(session), sum(before),
                    ),
                )
            )
        )
    return sorted(features, key=lambda row: tuple(repr(row[name]) for name in FEATURE_COLUMNS))


def expected_after(events, cuts, start, end):
    """Features of the range from `start` to `end` when ranges that begin at `cuts` were run
    before: one computation, in which a session is one in each range that it touches."""
    users = defaultdict(set)
    for e in events:
        users[e[8]].add(e[7])
    divided = [
        (*e[:8], f"{sum(e[0] >= cut for cut in cuts)}|{e[8]}") for e in events
        if e[0] is not None and e[8] is not None and len(users[e[8]]) == 1
    ]
    number = f"{sum(start >= cut for cut in cuts)}|"
    rows = expected_features(divided, cuts[0], end)
    mine = [row | {"user_session": row["user_session"][len(number):]} for row in rows if row["user_session"].startswith(number)]
    return sorted(mine, key=lambda row: tuple(repr(row[name]) for name in FEATURE_COLUMNS))


def random_events(seed: int, count: int = 200):
    """Events with every awkward case: ties, nulls, shared sessions, price changes, repeats."""
    pick = random.Random(seed)
    events = []
    for _ in range(count):
        number = pick.randrange(25)
        user = None if number % 9 == 8 else f"u{number % 3}"
        if pick.random() < 0.01:
            user = "stranger"
        events.append(
            event(
                None if pick.random() < 0.1
                else DAY + timedelta(minutes=10 * number % 70 + pick.randrange(4), days=number % 3),
                pick.choice(["view", "view", "view", "cart", "purchase", None]),
                pick.choice(["p1", "p2", "p3", None]),
                pick.choice([f"s{number}"] * 9 + [None]),
                user,
                pick.choice([1.0, 1.0, 2.0, None]),
                pick.choice(["b", None]),
                pick.choice(["c", "d"]),
            )
        )
    return events + events[:5]

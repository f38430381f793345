"""Small documents in the landed shapes."""

from __future__ import annotations

import json
from pathlib import Path

SPOT = {"period": {"number": 1}, "clock": {"displayValue": "15:00"}}


def team(ident, name, where, score):
    return {"id": ident, "homeAway": where, "score": score,
            "team": {"name": name, "abbreviation": name[:2].upper(), "displayName": f"The {name}",
                     "shortDisplayName": name, "color": "000000", "alternateColor": "ffffff",
                     "logo": "http://x/l.png", "venue": {"id": "9"}}}


def event(ident, date, week, teams, state="MA", season=2025):
    address = {"city": "Town", "country": "USA"} | ({"state": state} if state else {})
    return {"id": str(ident), "date": date, "season": {"year": season}, "week": {"number": week},
            "competitions": [{"attendance": 100, "competitors": teams,
                              "venue": {"id": "9", "fullName": "Field", "indoor": False,
                                        "address": address}}]}


def scoreboard(*events):
    return {"leagues": [{"season": {"year": 2025}}], "events": list(events)}


def players(team_id, abbr, *categories):
    return {"team": {"id": team_id, "abbreviation": abbr}, "statistics": [
        {"name": name, "keys": keys, **({"labels": labels} if labels is not None else {}),
         "athletes": [{"athlete": {"id": a, "displayName": n}, "stats": stats}
                      for a, n, stats in athletes]}
        for name, keys, labels, athletes in categories]}


PASSING = ["completions/passingAttempts", "passingYards", "passingTouchdowns", "interceptions",
           "sacks-sackYardsLost", "QBRating"]
RECEIVING = ["receptions", "receivingYards", "receivingTouchdowns"]


def game(week=1, article=True, season=2025, blocks=(), drives=None):
    doc = {
        "header": {"season": {"year": season} if season else {}, "week": week},
        "boxscore": {
            "teams": [{"homeAway": "home", "team": {"id": "1", "abbreviation": "AA"},
                       "statistics": [
                           {"name": "firstDowns", "displayValue": "20", "value": 20, "label": "1st"},
                           {"name": "thirdDown", "displayValue": "3-9", "value": "-", "label": "3rd"}]}],
            "players": list(blocks)},
    }
    if article:
        doc["article"] = {
            "id": 700 + week, "headline": "Home wins", "published": "2025-09-08T03:21:00Z",
            "source": "AP", "story": f"<p>Home   <b>wins</b> week {week}.</p><script>x</script>",
            "images": [{"type": "header", "name": "n", "caption": "c", "height": 5, "width": 6,
                        "url": "http://x/1.png"}, {"type": "header", "name": "no url"}]}
    if drives:
        doc["drives"] = {"previous": drives}
    return doc


def write(path: Path, doc) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(doc, indent=1))

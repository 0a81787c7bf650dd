"""Hand-made match documents with hand-counted results."""

import copy
import json

SAMPLE = {
    "meta": {"data_version": "1.1.0", "created": "2023-10-06", "revision": 1},
    "info": {
        "match_type_number": 9001, "match_type": "ODI", "season": "2023/24", "team_type": "international", "overs": 50,
        "venue": "Test  Ground", "gender": "male", "dates": ["2023-10-14"], "teams": ["alpha", "beta"],
        "players": {"alpha": ["a one", "a  two"], "beta": ["b one", " "]},
        "event": {"name": "Cup", "stage": "Final"}, "outcome": {"winner": "alpha", "by": {"runs": 3}},
        "player_of_match": ["a one"], "officials": {"umpires": ["u one", "u two"]},
        "toss": {"winner": "beta", "decision": "field"},
    },
    "innings": [
        {"team": "alpha", "overs": [{"over": 0, "deliveries": [
            {"bowler": "b one", "batter": "a one", "non_striker": "a  two", "runs": {"batter": 4, "extras": 0, "total": 4}},
            {"bowler": "b one", "batter": "a one", "non_striker": "a  two", "runs": {"batter": 0, "extras": 3, "total": 3}, "extras": {"wides": 1, "legbyes": 2}},
        ]}]},
        {"team": "beta", "overs": [{"over": 0, "deliveries": [
            {"bowler": "a one", "batter": "b one", "non_striker": " ", "runs": {"batter": 0, "extras": 0, "total": 0},
             "review": {"by": "beta", "decision": "struck down", "type": "wicket"},
             "wickets": [{"player_out": "b one", "kind": "run out", "fielders": [{"name": "a one"}, {"name": "a  two"}]}]},
            {"bowler": "a one", "batter": "b one", "non_striker": " ", "runs": {"batter": 6, "extras": 0, "total": 6}},
        ]}]},
    ],
}


def document(number, **info):
    doc = copy.deepcopy(SAMPLE)
    doc["info"]["match_type_number"] = number
    for key, value in info.items():
        if value is None:
            doc["info"].pop(key, None)
        else:
            doc["info"][key] = value
    return doc


def write(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content)
    (folder / name).write_text(text)

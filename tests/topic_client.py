"""A topic client for the sink's tests: staged and published records are files in a folder."""

import json
import os
import uuid


class FileTopic:
    def __init__(self, options):
        self.root, self.fail = options["folder"], options.get("fail_once")

    def _path(self, topic, *rest):
        path = os.path.join(self.root, topic, *rest)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return path

    def stage(self, topic, records):
        rows = [r for b in records for r in b.to_pylist()]
        token = uuid.uuid4().hex
        with open(self._path(topic, "staged", token), "w") as f:
            json.dump(rows, f)
        if self.fail and any(r["key"] == self.fail for r in rows) and not os.path.exists(self._path(topic, "failed")):
            open(self._path(topic, "failed"), "w").close()
            raise OSError("the task fails after it has staged its records")
        return token

    def publish(self, topic, run, epoch, tokens):
        beside = self._path(topic, "new", uuid.uuid4().hex)
        with open(beside, "w") as f:
            json.dump(tokens, f)
        try:
            os.link(beside, self._path(topic, "published", f"{run}-{epoch}"))     # once for each run and epoch
        except FileExistsError:
            self.discard(topic, tokens)

    def discard(self, topic, tokens):
        for t in tokens:
            os.unlink(self._path(topic, "staged", t))


def published(folder, topic):
    out, at = [], os.path.join(folder, topic, "published")
    for name in os.listdir(at) if os.path.isdir(at) else []:
        for token in json.load(open(os.path.join(at, name))):
            out += [(r["key"], r["value"]) for r in json.load(open(os.path.join(folder, topic, "staged", token)))]
    return sorted(out)

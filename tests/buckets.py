"""Policy and request buckets with valid, invalid, empty and missing files."""

import json
import os


def write(root, path, content):
    full = os.path.join(root, path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    if not isinstance(content, (str, bytes)):
        content = json.dumps(content)
    with open(full, "wb") as out:
        out.write(content if isinstance(content, bytes) else content.encode())


def size(count=None, percentage=None):
    given = {"count": count, "percentage": percentage}
    return {key: value for key, value in given.items() if value is not None}


def spec(kind, by=None, direction=None):
    if by is None:
        return {"type": kind}
    return {"type": kind, "properties": {"by": by, "direction": direction}}


DEFAULT = {
    "limit": size(640, 22.5),
    "default_sample": {"size": size(25, 3.0), "spec": spec("sorted", "booked_at", "ASC")},
}
TRIPS = {
    "limit": size(75, 80.0),
    "default_sample": {"size": size(12, 0.5), "spec": spec("sorted", "km", "DESC")},
}

# A shop and a fleet. Each table's policy and request stand for one way in which they can be laid together.
POLICIES = {
    "default_policy.json": DEFAULT,
    "shop/sales/receipts.json": "",
    "shop/sales/refunds.json": {},
    "shop/sales/baskets.json": {"default_sample": {"size": size(8)}},
    "shop/sales/archive/old.json": TRIPS,
    "shop/stock/shelves.json": {"limit": size(percentage=12.5)},
    "shop/stock/pallets.json": '{"limit": {"count": 9}, "default_sample": [',
    "fleet/trips/legs.json": TRIPS,
    "fleet/trips/stops.json": TRIPS,
    "fleet/trips/fuel.json": {"default_sample": {"spec": {"type": "sorted"}}},
    "fleet/depots/bays.json": {"limit": size(3)},
    "fleet/notes.md": "who owns which table",
}
REQUESTS = {
    "shop/sales/refunds.json": {"size": size(percentage=50.0), "spec": spec("random")},
    "shop/sales/baskets.json": {"size": size(31)},
    "shop/sales/vouchers.json": {"size": size(4)},
    "shop/stock/shelves.json": {"size": size(5000)},
    "shop/stock/pallets.json": {"spec": spec("sorted", "weight", "DESC")},
    "fleet/trips/legs.json": {"size": size("40"), "spec": spec("random")},
    "fleet/trips/stops.json": "size: 40",
    "fleet/depots/bays.json": {"spec": {"type": "sorted", "properties": {"by": "bay"}}},
}


def write_all(root, files):
    for path, content in files.items():
        write(root, path, content)
    return str(root)

import json

KEYS = [f"{p}/{i:03d}.zip" for p in ("a", "b") for i in range(25)]


def store(name):
    """A store of KEYS, or of the keys of a JSON file, that says how it was asked."""
    keys = sorted(json.load(open(name))) if name else KEYS
    calls = []

    def page(prefix, after, size):
        calls.append((prefix, after, size))
        found = [k for k in keys if k.startswith(prefix) and k > after]
        return [(k, len(k)) for k in found[:size]], len(found) > size

    page.calls = calls
    return page

"""Plain versions of operators that several test modules compare with."""

import hashlib
import re


def decontaminate(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], window: int = 10) -> list[tuple]:
    def cut(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    windows: dict[tuple, set[int]] = {}
    for i, text in items:
        w = cut(text)
        size = min(len(w), window)
        for p in range(len(w) - size + 1 if w and i is not None else 0):
            windows.setdefault(tuple(w[p:p + size]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, hit, found = cut(text), set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[p:p + size])):
                    hit.update(range(p, p + size))
                    found |= owners
        names = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out

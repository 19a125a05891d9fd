"""A decoder of text files for tests: pages are parted by form feeds, words by spaces."""


class File:
    def __init__(self, data: bytes):
        if data.startswith(b"BAD"):
            raise ValueError("no such format")
        self.parts = data.decode().split("\f")
        self.pages = len(self.parts)

    def page(self, number: int) -> dict:
        text = self.parts[number - 1]
        if text == "broken":
            raise ValueError("broken page")
        words = [{"text": w, "x0": float(i), "top": 1.0, "x1": i + 1.0, "bottom": 2.0, "size": 9.0, "fontname": "F"} for i, w in enumerate(text.split())]
        links = [{"index": i + 1, "uri": w} for i, w in enumerate(w for w in text.split() if "://" in w)]
        return {"words": words, "links": links, "text": [{"text": text}], "tables": [{"index": 1, "rows": [["a", None]]}]}

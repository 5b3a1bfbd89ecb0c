"""A logistic model as ONNX bytes, written field by field (there is no ONNX writer here)."""

import struct


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def num(field: int, value: int) -> bytes:
    return varint(field << 3) + varint(value)


def blob(field: int, value: bytes | str) -> bytes:
    value = value.encode() if isinstance(value, str) else value
    return varint(field << 3 | 2) + varint(len(value)) + value


def floats(name: str, values) -> bytes:
    packed = struct.pack(f"<{len(values)}f", *values)
    return blob(5, blob(1, name) + blob(7, packed) + num(20, 6))


def ints(name: str, values) -> bytes:
    return blob(5, blob(1, name) + blob(8, b"".join(varint(v) for v in values)) + num(20, 7))


def text(name: str, value: str) -> bytes:
    return blob(5, blob(1, name) + blob(4, value) + num(20, 3))


def node(op: str, inputs, outputs, *attributes: bytes) -> bytes:
    body = b"".join(blob(1, i) for i in inputs) + b"".join(blob(2, o) for o in outputs)
    return blob(1, body + blob(4, op) + b"".join(attributes) + blob(7, "ai.onnx.ml"))


def tensor(kind: int, *dims) -> bytes:
    shape = b"".join(blob(1, num(1, d) if isinstance(d, int) else blob(2, d)) for d in dims)
    return blob(1, num(1, kind) + blob(2, shape))


def value(field: int, name: str, kind: bytes) -> bytes:
    return blob(field, blob(1, name) + blob(2, kind))


def logistic(weights, bias: float, dicts: bool) -> bytes:
    """P(class 1) = sigmoid(weights . x + bias); probabilities as dicts per row or as N x 2."""
    coefficients = [-w for w in weights] + list(weights)
    scores = "scores" if dicts else "probabilities"
    nodes = node(
        "LinearClassifier",
        ["x"],
        ["label", scores],
        floats("coefficients", coefficients),
        floats("intercepts", [-bias, bias]),
        ints("classlabels_ints", [0, 1]),
        text("post_transform", "LOGISTIC"),
    )
    if dicts:
        nodes += node("ZipMap", ["scores"], ["probabilities"], ints("classlabels_int64s", [0, 1]))
        of_map = blob(5, num(1, 7) + blob(2, tensor(1)))
        kind = blob(4, blob(1, of_map))
    else:
        kind = tensor(1, "n", 2)
    graph = nodes + blob(2, "logistic") + value(11, "x", tensor(1, "n", len(weights)))
    graph += value(12, "label", tensor(7, "n")) + value(12, "probabilities", kind)
    opsets = blob(8, blob(1, "") + num(2, 13)) + blob(8, blob(1, "ai.onnx.ml") + num(2, 1))
    return num(1, 7) + blob(7, graph) + opsets

"""Framed payloads: a zero byte, a 4-byte big-endian schema id, the body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the frame layout -----------------------------------------------------
MAGIC = 0
ID_BYTES = 4
HEADER_BYTES = 5
# ----------------------------------------------------------------------------------------


def frame(schema_id: Column, body: Column) -> Column:
    """Bytes of a framed payload; null stays null."""
    unsigned = F.pmod(schema_id.cast("bigint"), F.lit(1 << 32))
    header = F.unhex(F.concat(F.lit("%02X" % MAGIC), F.lpad(F.hex(unsigned), 2 * ID_BYTES, "0")))
    return F.concat(header, body.cast("binary"))


def frame_error(payload: Column) -> Column:
    """Why a payload is not framed, or null."""
    return (
        F.when(payload.isNull(), F.lit(None))
        .when(F.octet_length(payload) < HEADER_BYTES, "frame too short")
        .when(F.hex(F.substring(payload, 1, 1)) != "%02X" % MAGIC, "bad magic byte")
    )


def frame_id(payload: Column) -> Column:
    """Signed 32-bit schema id; null if the payload is not framed."""
    raw = F.conv(F.hex(F.substring(payload, 2, ID_BYTES)), 16, 10).cast("bigint")
    signed = F.when(raw >= 1 << 31, raw - (1 << 32)).otherwise(raw).cast("int")
    return F.when(payload.isNotNull() & frame_error(payload).isNull(), signed)


def frame_body(payload: Column) -> Column:
    """Bytes after the header; null if the payload is not framed."""
    body = F.substr(payload, F.lit(HEADER_BYTES + 1))
    return F.when(payload.isNotNull() & frame_error(payload).isNull(), body)


# -- message indexes: which nested message type of a schema file a body has ----------------------


def _varint(number: Column) -> Column:
    """A number below 2^31 as a zig-zag varint, in hexadecimal."""
    zigzag = number.cast("bigint") * 2
    part = lambda k, last: F.lpad(F.hex((F.call_function("shiftright", zigzag, F.lit(7 * k)) % 128) + (0 if last else 128)), 2, "0")
    out = F.concat(*[part(k, False) for k in range(4)], part(4, True))
    for size in range(4, 0, -1):
        out = F.when(zigzag < 1 << (7 * size), F.concat(*[part(k, k == size - 1) for k in range(size)])).otherwise(out)
    return out


def message_indexes(indexes: Column) -> Column:
    """The bytes before a Protobuf body that name its message type: a count and the index at each level, or a zero byte
    for the first top-level message.  Null or empty indexes stand for that message too."""
    first = F.coalesce(F.size(indexes) <= 0, F.lit(True)) | ((F.size(indexes) == 1) & (F.get(indexes, F.lit(0)) == 0))
    listed = F.concat(_varint(F.size(indexes)), F.array_join(F.transform(indexes, _varint), ""))
    return F.unhex(F.when(first, "00").otherwise(listed))


def read_message_indexes(payload: Column) -> Column:
    """``indexes`` and ``size`` (the bytes they take) of what :func:`message_indexes` wrote before a body.

    Null for null, and for a list that is cut off or not well formed: a varint of more than five bytes, a negative
    number.  Any number of levels is read.
    """
    byte = lambda i: F.conv(F.hex(F.substr(payload, i, F.lit(1))), 16, 10).cast("bigint")
    start = F.struct(
        F.lit(0).cast("bigint").alias("value"), F.lit(0).alias("shift"), F.lit(-1).cast("bigint").alias("wanted"),
        F.array().cast("array<int>").alias("indexes"), F.lit(0).alias("size"),
    )

    def one(i: Column, state: Column) -> Column:
        def taken(b: Column) -> Column:
            value = state["value"] + F.call_function("shiftleft", b % 128, state["shift"])
            ends = b < 128
            number = (value / 2).cast("bigint")
            bad = (state["shift"] > 28) | (ends & (value % 2 != 0)) | (ends & (number >= 1 << 31))
            counts = state["wanted"] < 0
            # a count of zero stands for the first message
            wanted = F.when(bad, -2).when(~ends | ~counts, state["wanted"]).otherwise(number)
            indexes = F.when(ends & counts & (number == 0), F.array(F.lit(0))).when(ends & ~counts & ~bad, F.array_append(state["indexes"], number.cast("int")))
            done = ends & ~bad
            return F.struct(
                F.when(done, 0).otherwise(value).cast("bigint").alias("value"), F.when(done, 0).otherwise(state["shift"] + 7).alias("shift"),
                wanted.cast("bigint").alias("wanted"), F.coalesce(indexes, state["indexes"]).alias("indexes"), i.alias("size"),
            )

        over = (state["wanted"] == -2) | ((state["wanted"] >= 0) & (F.size(state["indexes"]) >= state["wanted"]))
        return F.when(over, state).otherwise(F.get(F.transform(F.array(byte(i)), taken), 0))

    def found(state: Column) -> Column:
        whole = (state["wanted"] >= 0) & (F.size(state["indexes"]) >= state["wanted"])
        return F.when(whole, F.struct(state["indexes"].alias("indexes"), state["size"].alias("size")))

    # a count of one byte tells how long its list can be: five bytes for each index
    size, count = F.octet_length(payload), byte(F.lit(1))
    most = F.when(count < 128, F.least(size, (1 + 5 * F.call_function("shiftright", count, F.lit(1))).cast("int"))).otherwise(size)
    places = F.sequence(F.lit(1), most)
    first = F.struct(F.array(F.lit(0)).alias("indexes"), F.lit(1).alias("size"))
    plain = F.hex(F.substring(payload, 1, 1)) == "00"  # most bodies are of the first message
    return F.when(plain, first).when(F.octet_length(payload) > 0, F.aggregate(places, start, lambda s, i: one(i, s), found))

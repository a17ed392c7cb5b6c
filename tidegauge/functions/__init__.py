"""Column expressions: averages, advice, event time, JSON."""

from .codec import decode_json, encode_json, quarantine
from .eventtime import emission_stamp, event_time
from .smoothing import advice, alpha, ema_step, fold_window, to_number

__all__ = [
    "advice",
    "alpha",
    "decode_json",
    "ema_step",
    "emission_stamp",
    "encode_json",
    "event_time",
    "fold_window",
    "quarantine",
    "to_number",
]

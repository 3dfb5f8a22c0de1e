from surgeflow.functions.columns import (effective_span_us, ntz, reason_text, safe_pct,
                                         span_seconds, key_number)

__all__ = ["effective_span_us", "ntz", "reason_text", "safe_pct", "span_seconds",
           "key_number"]

"""Structured Streaming over audit logs."""

from spanweave.streaming.late import verify_late_stream
from spanweave.streaming.verify import read_audit_stream, read_log_stream, verify_audit_stream

__all__ = ["read_audit_stream", "read_log_stream", "verify_audit_stream", "verify_late_stream"]

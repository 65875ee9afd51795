"""streamledger: offset-addressed message logs on Spark DataFrames.

Read topics by name, pattern or explicit offset range; tokenise and count
messages per batch or cumulatively; parse ``name,id`` messages; write keyed
upserts or appends whose results and offsets commit together.  Everything is
expressed with built-in DataFrame operators so Catalyst plans it.
"""

from streamledger.session import build_session, checkpoint_root, load_table

__all__ = ["build_session", "checkpoint_root", "load_table"]

"""wordmill: text-corpus preparation, tokenization and scoring as Spark jobs.

Every operator is a plain function ``DataFrame -> DataFrame`` that takes its
column names as arguments, so it composes with ``df.transform``. Modules
import without side effects: no session is created at import time.
"""

from wordmill.session import build_session, ensure_checkpoint_dir, load_table

__all__ = ["build_session", "ensure_checkpoint_dir", "load_table"]

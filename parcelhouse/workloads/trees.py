"""Text files at given paths, written by the executors.

Spark's own writers choose file names; a tree of ``sub-*/ses-*`` directories needs given
ones. The content comes as rows ``(path, content)``, each the size of one small file.
"""

import pandas as pd
from pyspark.sql import DataFrame


def write_text_tree(files: DataFrame, root: str) -> int:
    """Write every row to ``root/path``; any file system that Arrow reaches. Returns a count.

    A retried task writes the same bytes to the same place.
    """

    def write(batches):
        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                full = f"{base}/{path}"
                target.create_dir(full.rpartition("/")[0], recursive=True)
                with target.open_output_stream(full) as stream:
                    stream.write(content.encode("utf-8"))
            yield pd.DataFrame({"written": [len(batch)]})

    done = files.select("path", "content").mapInPandas(write, "written bigint")
    return done.groupBy().sum("written").first()[0] or 0

"""Saving and loading of Python-side models: parameters as metadata, one table as Parquet."""

from __future__ import annotations

from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter


class TableWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata=self.instance._state())
        table = self.instance._table()
        if table is not None:
            table.write.mode("overwrite").parquet(f"{path}/table")


class TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        table = f"{path}/table"
        model = self.cls._restore(metadata, table, self.sparkSession)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class TableStored(MLWritable, MLReadable):
    """Mixin: ``_state()`` goes to the metadata, ``_table()`` to Parquet, ``_restore`` reads both."""

    def write(self):
        return TableWriter(self)

    @classmethod
    def read(cls):
        return TableReader(cls)

    def _state(self) -> dict:
        return {}

    def _table(self):
        return None

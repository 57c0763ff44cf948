"""DataFrame operators (``DataFrame -> DataFrame``), usable with ``df.transform``."""

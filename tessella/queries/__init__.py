from tessella.queries.registry import QUERIES  # noqa: F401
from tessella.queries import neighbors  # noqa: F401
from tessella.queries import tiles  # noqa: F401
from tessella.queries import pixels  # noqa: F401
from tessella.queries import walks  # noqa: F401
from tessella.queries import vectors  # noqa: F401
from tessella.queries import jobs  # noqa: F401
from tessella.queries import streams  # noqa: F401

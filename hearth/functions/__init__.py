from hearth.functions.cleaning import *  # noqa: F401,F403
from hearth.functions.dates import *  # noqa: F401,F403
from hearth.functions.predicates import *  # noqa: F401,F403

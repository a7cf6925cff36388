from .binding import bind
from .greedy import assign_greedy
from .ordering import dealt_by_range, flag_hot, numbered, slice_of, slice_table, sliced

__all__ = ["assign_greedy", "bind", "dealt_by_range", "flag_hot", "numbered", "slice_of", "slice_table", "sliced"]

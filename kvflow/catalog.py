"""Command catalogue: group and key positions of every known command.

A key specification is written ``i1`` (begin at argument 1) or ``kw(STORE,6)`` (begin after the keyword STORE, searched
from argument 6; a negative start searches backwards from the end), then ``r(last,step,limit)`` (a range: last counts
from the begin, or from the end where negative; limit n > 1 takes the first 1/n of what is left) or
``n(count,first,step)`` (the argument at begin + count says how many keys follow from begin + first).
"""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Commands whose first argument is part of their name.
CONTAINERS = tuple("ACL CLIENT CLUSTER COMMAND CONFIG FUNCTION LATENCY MEMORY MODULE OBJECT PUBSUB SCRIPT SENTINEL SLOWLOG XGROUP XINFO".split())

#: Group; key specification; commands.  A ``NAME: A B`` part stands for NAME-A NAME-B.
CATALOGUE = """
SERVER; -; ACL: CAT DELUSER DRYRUN GENPASS GETUSER HELP LIST LOAD LOG SAVE SETUSER USERS WHOAMI; ACL BGREWRITEAOF BGSAVE; COMMAND: COUNT DOCS GETKEYS GETKEYSANDFLAGS HELP INFO LIST; COMMAND; CONFIG: GET HELP RESETSTAT REWRITE SET; CONFIG DBSIZE DEBUG FAILOVER FLUSHALL FLUSHDB INFO LASTSAVE; LATENCY: DOCTOR GRAPH HELP HISTOGRAM HISTORY LATEST RESET; LATENCY LOLWUT; MEMORY: DOCTOR HELP MALLOC-STATS PURGE STATS; MEMORY; MODULE: HELP LIST LOAD LOADEX UNLOAD; MODULE MONITOR PSYNC REPLCONF REPLICAOF ROLE SAVE SHUTDOWN SLAVEOF; SLOWLOG: GET HELP LEN RESET; SLOWLOG SWAPDB SYNC TIME
SERVER; i2 r(0,1,0); MEMORY: USAGE
SERVER; i1 r(0,1,0); RESTORE-ASKING
STRING; i1 r(0,1,0); APPEND DECR DECRBY GET GETDEL GETEX GETRANGE GETSET INCR INCRBY INCRBYFLOAT PSETEX SET SETEX SETNX SETRANGE STRLEN SUBSTR
STRING; i1 r(1,1,0); LCS
STRING; i1 r(-1,1,0); MGET
STRING; i1 r(-1,2,0); MSET MSETNX
CLUSTER; -; ASKING; CLUSTER: ADDSLOTS ADDSLOTSRANGE BUMPEPOCH COUNT-FAILURE-REPORTS COUNTKEYSINSLOT DELSLOTS DELSLOTSRANGE FAILOVER FLUSHSLOTS FORGET GETKEYSINSLOT HELP INFO KEYSLOT LINKS MEET MYID NODES REPLICAS REPLICATE RESET SAVECONFIG SET-CONFIG-EPOCH SETSLOT SHARDS SLAVES SLOTS; CLUSTER READONLY READWRITE
CONNECTION; -; AUTH; CLIENT: CACHING GETNAME GETREDIR HELP ID INFO KILL LIST NO-EVICT PAUSE REPLY SETNAME TRACKING TRACKINGINFO UNBLOCK UNPAUSE; CLIENT ECHO HELLO PING QUIT RESET SELECT
BITMAP; i1 r(0,1,0); BITCOUNT BITFIELD BITFIELD_RO BITPOS GETBIT SETBIT
BITMAP; i2 r(0,1,0) + i3 r(-1,1,0); BITOP
LIST; i1 r(0,1,0) + i2 r(0,1,0); BLMOVE BRPOPLPUSH LMOVE RPOPLPUSH
LIST; i2 n(0,1,1); BLMPOP
LIST; i1 r(-2,1,0); BLPOP BRPOP
LIST; i1 r(0,1,0); LINDEX LINSERT LLEN LPOP LPOS LPUSH LPUSHX LRANGE LREM LSET LTRIM RPOP RPUSH RPUSHX
LIST; i1 n(0,1,1); LMPOP
SORTED_SET; i2 n(0,1,1); BZMPOP
SORTED_SET; i1 r(-2,1,0); BZPOPMAX BZPOPMIN
SORTED_SET; i1 r(0,1,0); ZADD ZCARD ZCOUNT ZINCRBY ZLEXCOUNT ZMSCORE ZPOPMAX ZPOPMIN ZRANDMEMBER ZRANGE ZRANGEBYLEX ZRANGEBYSCORE ZRANK ZREM ZREMRANGEBYLEX ZREMRANGEBYRANK ZREMRANGEBYSCORE ZREVRANGE ZREVRANGEBYLEX ZREVRANGEBYSCORE ZREVRANK ZSCAN ZSCORE
SORTED_SET; i1 n(0,1,1); ZDIFF ZINTER ZINTERCARD ZMPOP ZUNION
SORTED_SET; i1 r(0,1,0) + i2 n(0,1,1); ZDIFFSTORE ZINTERSTORE ZUNIONSTORE
SORTED_SET; i1 r(0,1,0) + i2 r(0,1,0); ZRANGESTORE
GENERIC; i1 r(0,1,0) + i2 r(0,1,0); COPY RENAME RENAMENX
GENERIC; i1 r(-1,1,0); DEL EXISTS TOUCH UNLINK
GENERIC; i1 r(0,1,0); DUMP EXPIRE EXPIREAT EXPIRETIME MOVE PERSIST PEXPIRE PEXPIREAT PEXPIRETIME PTTL RESTORE TTL TYPE
GENERIC; -; KEYS; OBJECT: HELP; OBJECT RANDOMKEY SCAN WAIT
GENERIC; i2 r(0,1,0); OBJECT: ENCODING FREQ IDLETIME REFCOUNT
TRANSACTIONS; -; DISCARD EXEC MULTI UNWATCH
TRANSACTIONS; i1 r(-1,1,0); WATCH
SCRIPTING; i2 n(0,1,1); EVAL EVAL_RO EVALSHA EVALSHA_RO FCALL FCALL_RO
SCRIPTING; -; FUNCTION: DELETE DUMP FLUSH HELP KILL LIST LOAD RESTORE STATS; FUNCTION; SCRIPT: DEBUG EXISTS FLUSH HELP KILL LOAD; SCRIPT
TAIRHASH; i1 r(0,1,0); EXHSET
TAIRSTRING; i1 r(0,1,0); EXSET
TAIRZSET; i1 r(0,1,0); EXZADD
GEO; i1 r(0,1,0); GEOADD GEODIST GEOHASH GEOPOS GEORADIUS_RO GEORADIUSBYMEMBER_RO GEOSEARCH
GEO; i1 r(0,1,0) + kw(STORE,6) r(0,1,0) + kw(STOREDIST,6) r(0,1,0); GEORADIUS
GEO; i1 r(0,1,0) + kw(STORE,5) r(0,1,0) + kw(STOREDIST,5) r(0,1,0); GEORADIUSBYMEMBER
GEO; i1 r(0,1,0) + i2 r(0,1,0); GEOSEARCHSTORE
HASH; i1 r(0,1,0); HDEL HEXISTS HGET HGETALL HINCRBY HINCRBYFLOAT HKEYS HLEN HMGET HMSET HRANDFIELD HSCAN HSET HSETNX HSTRLEN HVALS
HYPERLOGLOG; i1 r(0,1,0); PFADD
HYPERLOGLOG; i1 r(-1,1,0); PFCOUNT
HYPERLOGLOG; i2 r(0,1,0); PFDEBUG
HYPERLOGLOG; i1 r(0,1,0) + i2 r(-1,1,0); PFMERGE
HYPERLOGLOG; -; PFSELFTEST
PUBSUB; -; PSUBSCRIBE PUBLISH; PUBSUB: CHANNELS HELP NUMPAT NUMSUB SHARDCHANNELS SHARDNUMSUB; PUBSUB PUNSUBSCRIBE SUBSCRIBE UNSUBSCRIBE
PUBSUB; i1 r(0,1,0); SPUBLISH
PUBSUB; i1 r(-1,1,0); SSUBSCRIBE SUNSUBSCRIBE
SET; i1 r(0,1,0); SADD SCARD SISMEMBER SMEMBERS SMISMEMBER SPOP SRANDMEMBER SREM SSCAN
SET; i1 r(-1,1,0); SDIFF SINTER SUNION
SET; i1 r(0,1,0) + i2 r(-1,1,0); SDIFFSTORE SINTERSTORE SUNIONSTORE
SET; i1 n(0,1,1); SINTERCARD
SET; i1 r(0,1,0) + i2 r(0,1,0); SMOVE
SENTINEL; -; SENTINEL: CKQUORUM CONFIG DEBUG FAILOVER FLUSHCONFIG GET-MASTER-ADDR-BY-NAME HELP INFO-CACHE IS-MASTER-DOWN-BY-ADDR MASTER MASTERS MONITOR MYID PENDING-SCRIPTS REMOVE REPLICAS RESET SENTINELS SET SIMULATE-FAILURE SLAVES; SENTINEL
STREAM; i1 r(0,1,0); XACK XADD XAUTOCLAIM XCLAIM XDEL XLEN XPENDING XRANGE XREVRANGE XSETID XTRIM
STREAM; i2 r(0,1,0); XGROUP: CREATE CREATECONSUMER DELCONSUMER DESTROY SETID; XINFO: CONSUMERS GROUPS STREAM
STREAM; -; XGROUP: HELP; XGROUP; XINFO: HELP; XINFO
STREAM; kw(STREAMS,1) r(-1,1,2); XREAD
STREAM; kw(STREAMS,4) r(-1,1,2); XREADGROUP
BLOOM FILTER; i1 r(0,1,0); BF.ADD BF.CARD BF.EXISTS BF.INFO BF.INSERT BF.LOADCHUNK BF.MADD BF.MEXISTS BF.RESERVE BF.SCANDUMP
"""


@dataclass(frozen=True)
class KeySpec:
    """begin: an argument index, or after keyword when that is set (searched from begin).  count < 0: a range."""

    begin: int
    keyword: str | None
    last: int
    step: int
    limit: int
    count: int
    first: int

    def positions(self, argv: list[bytes]) -> list[int]:
        """Argument indexes of the keys; none where the keyword or an argument is missing."""
        begin = self.begin
        if self.keyword is not None:
            upper = [a.upper() for a in argv]
            want = self.keyword.encode()
            places = range(begin, len(argv)) if begin >= 0 else range(len(argv) + begin, 0, -1)
            begin = next((i + 1 for i in places if upper[i] == want), len(argv))
        if begin >= len(argv):
            return []
        if self.count < 0:
            if self.last >= 0:
                end = begin + self.last
            else:
                end = len(argv) + self.last
                if self.limit > 1:
                    end = begin + (len(argv) - begin) // self.limit - 1
            return [i for i in range(begin, end + 1, self.step) if i < len(argv)]
        if begin + self.count >= len(argv):
            return []
        try:
            n = int(argv[begin + self.count])
        except ValueError:
            return []
        return [i for i in range(begin + self.first, begin + self.first + n * self.step, self.step) if i < len(argv)]


def _spec(text: str) -> tuple[KeySpec, ...]:
    if text == "-":
        return ()
    out = []
    for part in text.split(" + "):
        where, what = part.split(" ")
        keyword = None
        if m := re.fullmatch(r"kw\((\w+),(-?\d+)\)", where):
            keyword, begin = m[1], int(m[2])
        else:
            begin = int(where[1:])
        a, b, c = map(int, re.findall(r"-?\d+", what))
        out.append(KeySpec(begin, keyword, a, b, c, -1, 0) if what[0] == "r" else KeySpec(begin, keyword, 0, c, 0, a, b))
    return tuple(out)


@cache
def commands() -> dict[str, tuple[str, tuple[KeySpec, ...]]]:
    """name -> (group, key specifications)."""
    found: dict[str, tuple[str, tuple[KeySpec, ...]]] = {}
    for line in CATALOGUE.strip().splitlines():
        group, spec, *names = line.split("; ")
        for part in names:
            head, colon, tail = part.partition(": ")
            for name in tail.split() if colon else part.split():
                full = f"{head}-{name}" if colon else name
                if full in found:
                    raise ValueError(f"{full} is listed twice")
                found[full] = (group, _spec(spec))
    return found


_SPEC = pa.struct([("begin", pa.int32()), ("keyword", pa.binary()), *((f, pa.int32()) for f in ("last", "step", "limit", "count", "first"))])


def catalog_frame(spark: SparkSession) -> DataFrame:
    """cmd_name, group, specs: a few hundred rows, always small enough to broadcast.  Arrow makes it a constant of the plan."""
    known = sorted(commands().items())
    specs = [[asdict(s) | {"keyword": s.keyword.encode() if s.keyword else None} for s in found] for _, (_, found) in known]
    columns = [pa.array([n for n, _ in known]), pa.array([g for _, (g, _) in known]), pa.array(specs, pa.list_(_SPEC))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, ["cmd_name", "group", "specs"]))

"""Brute-force forms of the operators."""
import hashlib,re,zlib,collections
W=re.compile(r'[^\x20\x09-\x0D]+')
def op3(docs):
    g=collections.defaultdict(list); norm={}
    for d,t in docs:
        n=re.sub(r'[\x20\x09-\x0D]+',' ',t or ''); norm[d]=n; g[n].append(d)
    return {d:(min(g[norm[d]]),len(g[norm[d]]),d==min(g[norm[d]]),hashlib.sha256(norm[d].encode()).hexdigest()) for d,t in docs}
def low(t): return ''.join(chr(ord(c)+32) if 'A'<=c<='Z' else c for c in t)
def op6(docs,thr=80):
    sets={}
    for d,t in docs:
        w=W.findall(low(t or '')); sets[d]=frozenset(zip(w,w[1:])) if len(w)>1 else frozenset([tuple(w)] if w else [])
    par={d:d for d in sets}
    def find(x):
        while par[x]!=x: par[x]=par[par[x]]; x=par[x]
        return x
    inv=collections.defaultdict(list); byset=collections.defaultdict(list)
    for d,s in sets.items():
        if s: byset[s].append(d)
    reps={min(v):k for k,v in byset.items()}
    for k,v in byset.items():
        for x in v: 
            a,b=find(min(v)),find(x); par[max(a,b)]=min(a,b)
    for d,s in reps.items():
        for x in s: inv[x].append(d)
    for d,s in reps.items():
        # prefix by rarity: must share one of the rarest 20% + 1
        o=sorted(s,key=lambda x:(len(inv[x]),x)); c=set()
        for x in o[:len(s)-(len(s)*thr+99)//100+1]: c.update(inv[x])
        for e in c:
            if e<d:
                i=len(s&sets[e])
                if 100*i>=thr*(len(s)+len(sets[e])-i):
                    a,b=find(d),find(e); par[max(a,b)]=min(a,b)
    return {d:(len(s),find(d),find(d)==d) for d,s in sets.items()}
def op1(docs,w=50):
    first={}
    toks={d:W.findall(t or '') for d,t in docs}
    for d in sorted(toks):
        x=toks[d]
        for i in range(len(x)-w+1): first.setdefault(hash(tuple(x[i:i+w])),d)
    out={}
    for d,x in toks.items():
        cut=[False]*len(x); last=-1
        for i in range(len(x)-w+1):
            if first[hash(tuple(x[i:i+w]))]<d:
                for j in range(max(i,last),i+w): cut[j]=True
                last=i+w
        k=[a for a,b in zip(x,cut) if not b]
        out[d]=(len(x),sum(cut),hashlib.sha256(' '.join(k).encode()).hexdigest())
    return out
def op10(t):
    t=t or ''; sp=[]
    for m in re.finditer(r'''((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''',t):
        if len(m[2])>=12: sp.append((m.start(),0,m.end(),'assign'))
    for m in re.finditer('AKIA[A-Z0-9]+',t):
        if len(m[0])>=18: sp.append((m.start(),1,m.end(),'access'))
    for m in re.finditer('[0-9a-f]+',t):
        if len(m[0])>=16: sp.append((m.start(),2,m.end(),'hex'))
    return dig(sp,('assign','access','hex'))
def dig(sp,kinds):
    sp.sort(); s=','.join(f'{k}:{a}:{b}' for a,_,b,k in sp)
    return tuple(sum(x[3]==k for x in sp) for k in kinds)+(hashlib.sha256(s.encode()).hexdigest(),)
def luhn(d):
    t=0
    for i,c in enumerate(reversed(d)):
        n=int(c)
        if i%2: n=n*2-9 if n>4 else n*2
        t+=n
    return t%10==0
def op2(t):
    t=t or ''; sp=[]
    for m in re.finditer(r'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+',t): sp.append((m.start(),0,m.end(),'email'))
    for m in re.finditer(r'[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)',t):
        if all(int(x)<=255 for x in m[0].split('.')): sp.append((m.start(),1,m.end(),'ip'))
    for m in re.finditer(r'[0-9]([\x20-]?[0-9])+',t):
        d=re.sub('[^0-9]','',m[0])
        if 12<=len(d)<=19 and luhn(d): sp.append((m.start(),2,m.end(),'card'))
    for m in re.finditer(r'\+[0-9][\x20().0-9-]+[0-9]',t):
        if 9<=len(re.sub('[^0-9]','',m[0]))<=15: sp.append((m.start(),3,m.end(),'phone'))
    return dig(sp,('email','ip','card','phone'))
